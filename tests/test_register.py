"""The register pipeline (C01-C04) on literal rows with the original
vocabularies: zone exemption of the reference year, duplicate rows, a key
only in the base year, a gap year, zones that differ between main years."""

from panelkit.operators import category_codes
from panelkit.plans.register import (
    CleanOptions, build_panel, clean_base_year, clean_history, clean_main_year, fit_fsa_dictionary, register_panel,
)
from panelkit.sources.readers import REGISTER_COLUMNS


def reg_rows(spark, rows):
    full = [tuple(r.get(c, "") for c in REGISTER_COLUMNS) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in REGISTER_COLUMNS))


def R(pid, year, legal="LAND", zone="", cat="", postal="V6B 1A1", cur="100", imp="10", pre="90", preimp="9"):
    return {"PID": pid, "taxAssess": str(year), "legalType": legal, "zoneName": zone, "zoneCat": cat,
            "postalCode": postal, "curVal": cur, "curImpVal": imp, "preVal": pre, "preImpVal": preimp}


def test_register_panel_on_literals(spark):
    main = reg_rows(spark, [
        R("A", 2016, zone=""),                       # reference year: kept without a zone -> 'CD'
        R("A", 2015, zone=""),                       # other main year: dropped (no zone)
        R("B", 2015, zone="RS-1", postal="V5K 0A1"),
        R("B", 2016, zone="RT-2", legal="STRATA"),
        R("B", 2016, zone="RT-2", legal="LAND"),     # duplicate: LAND sorts first and is kept
        R("E", 2016, zone="Commercial", cat="Commercial", postal="V6B1A1X"),  # no FSA
    ])
    hist = reg_rows(spark, [
        R("B", 2006, cur="50", imp="5"), R("B", 2007, cur="60", imp="6"), R("B", 2009, cur="80", imp="8"),
        R("C", 2006, cur="70"),                      # no main-year zone: dropped by the backfill
    ])
    p = register_panel(main, hist, [2015, 2016], 2006, [2007, 2008, 2009], 2016, CleanOptions(), persist=None)
    d = {r.value: r.code for r in category_codes(p["dictionary"]).collect()}
    assert d == {"V6B": "1"}  # the 2016 rows with a valid FSA: A and B (E has none)
    m = sorted((r.PID, r.year, r.legalType, r.zoneCat, r.FSA) for r in p["main"].collect())
    assert m == [("A", 2016, "100", "000001000", "1"), ("B", 2015, "100", "100000000", None),
                 ("B", 2016, "100", "010000000", "1"), ("E", 2016, "100", "000010000", None)]
    base = [(r.PID, r.zoneCat, r.preVal, r.preImpVal) for r in p["base"].collect()]
    assert base == [("B", "010000000", 49.5, 4.95)]
    hist_rows = sorted((r.PID, r.year, r.preVal, r.zoneCat) for r in p["history"].collect())
    assert hist_rows == [("B", 2007, 50.0, "010000000")]  # 2009 has no 2008 row
    assert p["panel"].count() == 4 + 1 + 1
    q = {r.step: r for r in p["quality"].collect()}
    assert {s: r.rows for s, r in q.items()} == {"main": 4, "base": 1, "history": 1}
    assert q["main"].empty_FSA == 2 and q["main"].empty_preVal == 0
    assert {(r.PID, r.year): r.fsaText for r in p["main"].collect()}["B", 2015] == "V5K"  # not in the dictionary, kept as text
    # the composites called one by one give the same rows
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    words = fit_fsa_dictionary(main, 2016)
    whole = clean_main_year(main, [2015, 2016], words, zone_exempt=[2016])
    base = clean_base_year(hist, 2006, words, whole)
    history = clean_history(hist, 2006, [2007, 2008, 2009], words, whole)
    assert [rows(whole), rows(base), rows(history)] == [rows(p["main"]), rows(p["base"]), rows(p["history"])]
    assert rows(build_panel(whole, base, history)) == rows(p["panel"])
