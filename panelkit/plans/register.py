"""Register cleaning and the panel.

One plan covers all years: ``year`` is a key column, so a whole set of yearly
files is scanned once and cleaned by one set of shuffles instead of a union
that grows by two joins per year."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.predicates import has_key, has_length, has_value
from panelkit.functions.text import prefix_before
from panelkit.operators.encode import (
    LEGAL_TYPES, ZONE_CODES, ZONE_NAMES, encode_categories, encode_legal, encode_zone, fit_categories,
)
from panelkit.operators.keys import dedup_by_key, dedup_within_key
from panelkit.operators.panel import backfill_attribute, fill_from, impute_prior, prior_value, stack_years
from panelkit.operators.quality import quality_report
from panelkit.session import ensure_checkpoint_dir
from panelkit.stages import store_stage

# The panel's columns; fsaText beside them keeps the text that FSA encodes.
PANEL_COLUMNS = ("PID", "legalType", "zoneCat", "curVal", "curImpVal", "year", "preVal", "preImpVal", "FSA", "fsaText")
VALUE_COLUMNS = ("curVal", "curImpVal", "preVal", "preImpVal")
MAIN_SELECT = ("PID", "legalType", "zoneName", "zoneCat", "postalCode", "curVal", "curImpVal",
               "taxAssess", "preVal", "preImpVal")
#: The cleaning steps of a panel's rows.
STEPS = ("main", "base", "history")
# Fixed value: a key's first year has no prior; it takes this share of the current value.
FIRST_FACTOR = 0.99
HISTORY_SELECT = ("PID", "legalType", "postalCode", "curVal", "curImpVal", "taxAssess")


@dataclass
class CleanOptions:
    """Parameters shared by the cleaning steps (defaults: the register's own
    vocabularies; the stand-in passes its own)."""
    postal_len: int | None = 7
    zone_names: tuple = ZONE_NAMES
    zone_codes: tuple = ZONE_CODES
    zone_missing: str = "CD"
    legal_values: tuple = LEGAL_TYPES
    unseen: str = "null"


def select_valid(register: DataFrame, years, columns, opts: CleanOptions, require_zone: bool,
                 zone_exempt=()) -> DataFrame:
    """W01 + W02 (+ W03, except for the ``zone_exempt`` years), then D01 per
    key and year, then T01 (FSA). Filters come before the dedup, so a row
    that fails them can never be the one kept. With ``years`` the rows are laid
    out by key alone, for the windows and joins on it that follow."""
    cond = has_key("PID")
    if opts.postal_len is not None:
        cond = cond & has_length("postalCode", opts.postal_len)
    if require_zone:
        zone_ok = has_value("zoneName")
        if zone_exempt:
            zone_ok = zone_ok | F.col("taxAssess").isin([str(y) for y in zone_exempt])
        cond = cond & zone_ok
    rows = register.where(cond).select(*columns)
    if years is None:
        rows = dedup_by_key(rows, ["PID", "taxAssess"])
    else:
        rows = dedup_within_key(rows, "PID", "taxAssess", [str(y) for y in years])
    return rows.withColumn("FSA", prefix_before("postalCode", " ", strip=True))


def fit_fsa_dictionary(register: DataFrame, reference_year, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """F01 fit on the clean rows of the reference year."""
    rows = select_valid(register, [reference_year], MAIN_SELECT, opts, require_zone=False)
    return fit_categories(rows, "FSA")


def _typed(df: DataFrame) -> DataFrame:
    """The panel's columns, FSA still as text."""
    cols = []
    for c in PANEL_COLUMNS:
        if c == "year":
            cols.append(F.col("taxAssess").try_cast("int").alias("year"))
        elif c in VALUE_COLUMNS:
            cols.append(F.col(c).try_cast("double").alias(c))
        elif c in df.columns:
            cols.append(F.col(c))
    return df.select(*cols)


def with_codes(df: DataFrame, dictionary: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """F01 on typed rows, FSA's text beside its code. The codes come last, so a
    dictionary too large to broadcast moves the rows once, after all that works
    by key."""
    return encode_categories(df, "FSA", dictionary, unseen=opts.unseen, raw="fsaText").select(*PANEL_COLUMNS)


def typed_main(valid: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """P07 F02 F03 P02 on rows from :func:`select_valid`."""
    rows = fill_from(valid, "zoneCat", "zoneName", lambda c: prefix_before(c, "-", missing=opts.zone_missing))
    rows = encode_zone(rows, "zoneCat", opts.zone_names, opts.zone_codes)
    return _typed(encode_legal(rows, "legalType", opts.legal_values))


def encode_main(valid: DataFrame, dictionary: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """F01 P07 F02 F03 P02 on rows from :func:`select_valid`."""
    return with_codes(typed_main(valid, opts), dictionary, opts)


def clean_main_year(register: DataFrame, years, dictionary: DataFrame,
                    opts: CleanOptions = CleanOptions(), zone_exempt=()) -> DataFrame:
    """S01 W01 W02 W03 D01 T01 F01 P07 F02 F03 P02; one row per key and
    year. The zone filter (W03) is not applied to ``zone_exempt`` years (the
    reference year was cleaned without it)."""
    return encode_main(select_valid(register, years, MAIN_SELECT, opts, True, zone_exempt), dictionary, opts)


def typed_history(register: DataFrame, years, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """Historical rows after W01 W02 D01 T01 F03, typed, one per key and year."""
    rows = select_valid(register, years, HISTORY_SELECT, opts, require_zone=False)
    rows = encode_legal(rows, "legalType", opts.legal_values)
    for c in ("zoneCat", "preVal", "preImpVal"):
        rows = rows.withColumn(c, F.lit(None).cast("string"))
    return _typed(rows)


def base_from_rows(rows: DataFrame, base_year: int, main: DataFrame, factor: float = FIRST_FACTOR,
                   how: str = "inner") -> DataFrame:
    """C02 from prepared history rows: P05 then J01."""
    rows = impute_prior(rows.where(F.col("year") == F.lit(base_year)), factor=factor)
    return backfill_attribute(rows, main, "PID", ["zoneCat"], ["year"], how)


def history_from_rows(rows: DataFrame, base_year: int, years, main: DataFrame, mode: str = "previous_year",
                      how: str = "inner") -> DataFrame:
    """C03 from prepared rows of the base and history years: J02 then J01."""
    priced = prior_value(rows, "PID", "year", mode=mode, base_year=base_year, how=how)
    priced = priced.where(F.col("year").isin(list(years)))
    return backfill_attribute(priced, main, "PID", ["zoneCat"], ["year"], how)


def prepare_history(history: DataFrame, years, dictionary: DataFrame,
                    opts: CleanOptions = CleanOptions()) -> DataFrame:
    """Historical rows after W01 W02 D01 T01 F01 F03, typed, one per key and year."""
    return with_codes(typed_history(history, years, opts), dictionary, opts)


def clean_base_year(history: DataFrame, base_year: int, dictionary: DataFrame, main: DataFrame,
                    opts: CleanOptions = CleanOptions(), factor: float = FIRST_FACTOR, how: str = "inner") -> DataFrame:
    """S02 W01 W02 D01 T01 F01 F03 P05 J01. Prior values are ``factor`` x
    current; the zone comes from the key's latest main-year row."""
    return with_codes(base_from_rows(typed_history(history, [base_year], opts), base_year, main, factor, how), dictionary, opts)


def clean_history(history: DataFrame, base_year: int, years, dictionary: DataFrame, main: DataFrame,
                  opts: CleanOptions = CleanOptions(), mode: str = "previous_year", how: str = "inner") -> DataFrame:
    """S02 W01 W02 D01 T01 F01 F03 J02 J01 for the history years.

    The prior value of a year is the same key's clean current value of the
    previous year (``previous_year``, the base year included) or of the base
    year (``base_year``). Rows without a prior, or without a main-year zone,
    are dropped (inner joins, as before)."""
    rows = typed_history(history, [base_year, *years], opts)
    return with_codes(history_from_rows(rows, base_year, years, main, mode, how), dictionary, opts)


def build_panel(main: DataFrame, base: DataFrame, history: DataFrame) -> DataFrame:
    """Main years + base year + history years."""
    return stack_years([main, base, history], numeric=VALUE_COLUMNS)


def materialize(df: DataFrame, how: str | None = "checkpoint", readers: int | None = None) -> DataFrame:
    """Materialize a frame that several later stages read.

    ``'table'`` (default of the pipeline): a stage table of the job's ledger
    (:mod:`panelkit.stages`), written once as Parquet in a new folder below
    ``spark.checkpoint.dir`` and read back. This cuts the lineage on reliable
    storage, and unlike a checkpoint every reader still gets column pruning
    and filter pushdown on it; with ``readers`` the table goes when the last
    of so many frames written from it is there.
    ``'checkpoint'``: eager ``checkpoint()`` into the same shared folder.
    ``'cache'``: memory-and-disk cache (lost blocks are recomputed from the
    lineage; release with ``unpersist`` after the sink). ``None``: lazy."""
    if how == "table":
        return store_stage(df, readers=readers)
    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "cache":
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
        out.count()
        return out
    if how is None:
        return df
    raise ValueError("persist must be 'table', 'checkpoint', 'cache' or None")


class RegisterPanel:
    """C01-C04 wired together, built on first use.

    Only the valid main-year rows are read by several stages (dictionary, main
    output, zone backfill) and therefore materialized (``persist``). The history
    rows have one reader in every stage, and their layout by key serves dedup,
    prior values and backfill, so they are not written in between. A job that
    writes the panel and nothing else says ``panel_only``: the valid rows then
    go from disk when the panel is there (inside a ledger's block).
    Index by stage name: ``valid_main``, ``dictionary``, ``main``, ``rows``,
    ``base``, ``history``, ``panel``, ``quality``."""

    def __init__(self, register_main: DataFrame, register_hist: DataFrame, main_years, base_year: int,
                 history_years, reference_year: int, opts: CleanOptions = CleanOptions(),
                 mode: str = "previous_year", persist: str | None = "table", panel_only: bool = False):
        self.panel_only = panel_only
        self.register_main, self.register_hist = register_main, register_hist
        self.main_years, self.base_year, self.history_years = list(main_years), base_year, list(history_years)
        self.reference_year, self.opts, self.mode, self.persist = reference_year, opts, mode, persist
        self._done: dict = {}

    def _once(self, name, build):
        if name not in self._done:
            self._done[name] = build()
        return self._done[name]

    @property
    def valid_main(self) -> DataFrame:
        """All main years filtered and deduplicated in one pass (the reference
        year without the zone filter)."""
        return self._once("valid_main", lambda: materialize(
            select_valid(self.register_main, self.main_years, MAIN_SELECT, self.opts, True,
                         zone_exempt=[self.reference_year]), self.persist,
            readers=2 if self.panel_only else None))  # the dictionary and the panel

    @property
    def dictionary(self) -> DataFrame:
        """Not materialized again: :func:`number_rows` has stored its rows."""
        ref = self.valid_main.where(F.col("taxAssess") == F.lit(str(self.reference_year)))
        return self._once("dictionary", lambda: fit_categories(ref, "FSA"))

    @property
    def main(self) -> DataFrame:
        """Not materialized: an encoding join over ``valid_main`` is cheap to repeat."""
        return self._once("main", lambda: with_codes(self._main, self.dictionary, self.opts))

    @property
    def _main(self) -> DataFrame:
        return typed_main(self.valid_main, self.opts)

    @property
    def rows(self) -> DataFrame:
        """Base and history years, one row per key and year, laid out by key."""
        return self._once("rows", lambda: prepare_history(
            self.register_hist, [self.base_year, *self.history_years], self.dictionary, self.opts))

    @property
    def _before_main(self) -> DataFrame:
        """The priors of base and history rows from one window, then one backfill
        for both: the history files are exchanged once, by key."""
        rows = typed_history(self.register_hist, [self.base_year, *self.history_years], self.opts)
        priced = prior_value(rows, "PID", "year", mode=self.mode, base_year=self.base_year, first_factor=FIRST_FACTOR)
        priced = priced.where(F.col("year").isin([self.base_year, *self.history_years]))
        return backfill_attribute(priced, self._main, "PID", ["zoneCat"], ["year"])

    @property
    def before_main(self) -> DataFrame:
        """C02 and C03 together."""
        return self._once("before_main", lambda: with_codes(self._before_main, self.dictionary, self.opts))

    @property
    def base(self) -> DataFrame:
        """C02 alone: only the base year's rows are read."""
        return clean_base_year(self.register_hist, self.base_year, self.dictionary, self._main, self.opts)

    @property
    def history(self) -> DataFrame:
        return self.before_main.where(F.col("year").isin(self.history_years))

    @property
    def panel(self) -> DataFrame:
        """All years stacked, then one encoding for all."""
        return with_codes(stack_years([self._main, self._before_main], numeric=VALUE_COLUMNS), self.dictionary, self.opts)

    @property
    def step(self) -> Column:
        """The cleaning step that a panel row comes from."""
        return (F.when(F.col("year") == F.lit(self.base_year), "base")
                .when(F.col("year").isin(self.history_years), "history").otherwise("main"))

    @property
    def quality(self) -> DataFrame:
        """A06 for each cleaning step (``main``, ``base``, ``history``):
        empty-or-NULL counts of every column in one pass (the old per-step
        check ran one job per column)."""
        return quality_report(self.panel.withColumn("step", self.step), by="step")

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)


def register_panel(register_main: DataFrame, register_hist: DataFrame, main_years, base_year: int,
                   history_years, reference_year: int, opts: CleanOptions = CleanOptions(),
                   mode: str = "previous_year", persist: str | None = "table", panel_only: bool = False) -> RegisterPanel:
    """See :class:`RegisterPanel`."""
    return RegisterPanel(register_main, register_hist, main_years, base_year, history_years, reference_year,
                         opts, mode, persist, panel_only)
