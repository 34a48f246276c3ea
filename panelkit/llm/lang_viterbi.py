"""Language identification of whole and of mixed-language texts.

Training counts, per language, hashed character n-grams (one to four
characters, with word borders) of the words of labelled texts, and which
scripts its letters use. A word's score in a language is its smoothed log
likelihood; script ranges narrow the candidates first: a language that does
not write one of the word's scripts is out. A Viterbi pass over the words,
which pays ``penalty`` for each change of language, labels spans. The text's
language is the one with most letters; its score is that language's share of
all letters (0 to 1). The score says nothing of how well the language fits, as
some learned language is always the best; ``fit`` does, and ``drop_rejected``
compares it with the fit of labelled texts.

Training reads every word of every labelled text, and the usual fits are those
of all labelled texts; nothing is sampled. Words are counted in tables of bounded
size in the tasks, then by an aggregation. The model is a matrix of 65,536
buckets by languages, all that reaches the driver and every task; beside it a
few rows of each language come back for its usual fit.

Null texts and texts without a letter are ``und`` with score 0, as is
everything when nothing could be learned. Words whose scripts no learned
language uses count as letters but for no language. Languages that tie are
taken in code-point order. Rows are independent; repeated rows, extra columns
and empty tables need no care. Null ids are scored, never learned from.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm._memory import lean
from panelkit.llm._tables import stored

BUCKETS = 1 << 16
LONGEST_GRAM = 4
#: A language writes a script if at least this share of its training letters is in it.
SCRIPT_SHARE = 0.001
#: Words of one Viterbi block (bounds a task's memory; one longer text is a block of its own).
BLOCK_WORDS = 1_000_000
#: Words that a task remembers, and how many are scored together.
KNOWN = 400_000
SCORED_AT_ONCE = 50_000
#: Rows that a task holds as Python objects at once.
SLICE = 1_000
#: Words of all languages that a task counts before it hands the counts on.
COUNTED = 100_000
#: Bins of a unit of fit: the ranks of a quantile are first placed in bins, then read inside them.
FIT_BINS = 4_096
UNDETERMINED = "und"

#: First and last code points of scripts; other letters are "other".
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}
WORD = re.compile(r"[^\W\d_]+")


class Letters:
    """The characters of many words at once: code points, the word each one
    belongs to, and the scripts of those that are letters."""

    def __init__(self, words: list[str]):
        marked = [f"<{w}>" for w in words]
        self.n = len(words)
        self.points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        self.lengths = np.array([len(m) for m in marked], np.int64)
        self.word = np.repeat(np.arange(self.n), self.lengths)
        self.place = np.arange(len(self.points)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)

    def grams(self):
        """Word and bucket of every n-gram, for one n after the other."""
        left = self.lengths[self.word] - self.place
        for n in range(1, LONGEST_GRAM + 1):
            at = np.flatnonzero(left >= n)
            mixed = np.full(len(at), n, np.uint64)
            for k in range(n):
                mixed = (mixed ^ self.points[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            yield self.word[at], (mixed >> np.uint64(20)).astype(np.int64) % BUCKETS

    def scripts(self) -> tuple[np.ndarray, np.ndarray]:
        """Word and script number of every letter."""
        points, which = np.unique(self.points, return_inverse=True)
        letter = np.array([chr(c).isalpha() for c in points.tolist()], bool)
        ranges = sorted((first, last, i) for i, r in enumerate(SCRIPTS.values()) for first, last in r)
        first, last, number = (np.array(x) for x in zip(*ranges))
        at = np.maximum(np.searchsorted(first, points, "right") - 1, 0)
        script = np.where((points >= first[at]) & (points <= last[at]), number[at], len(SCRIPTS))
        keep = letter[which]
        return self.word[keep], script[which][keep]


def _word_counts(batches):
    counts = defaultdict(Counter)

    def rows():
        langs, words, n = ([x for lang, c in counts.items() for x in column(lang, c)]
                           for column in (lambda lang, c: [lang] * len(c), lambda lang, c: c.keys(), lambda lang, c: c.values()))
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(n, pa.int64())],
                                          names=["lang", "word", "n"])
    for b in batches:
        for text, lang in zip(b.column(0), b.column(1).to_pylist()):
            counts[lang].update(WORD.findall(text.as_py().lower()))
            if sum(map(len, counts.values())) > COUNTED:
                yield rows()
                counts.clear()
    if any(counts.values()):
        yield rows()


def _feature_counts(batches):
    """(lang, feature, n): n-gram buckets, and after them scripts, of distinct words."""
    width = BUCKETS + len(SCRIPTS) + 1
    counts = defaultdict(lambda: np.zeros(width, np.int64))
    for b in batches:
        langs, words, n = (b.column(i).to_pylist() for i in range(3))
        found = Letters(words)
        weight, lang = np.array(n, np.int64), np.array(langs, object)
        parts = [*found.grams(), (lambda w, s: (w, s + BUCKETS))(*found.scripts())]
        for x in set(langs):
            mine = lang == x
            for word, feature in parts:
                own = mine[word]
                counts[x] += np.bincount(feature[own], weights=weight[word[own]], minlength=width).astype(np.int64)
    for x, c in counts.items():
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([x] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(c[at], pa.int64())],
                                         names=["lang", "feature", "n"])


class Model:
    """Log probabilities [bucket, language], and which languages write each script."""

    def __init__(self, langs: list[str], log_p: np.ndarray, writes: np.ndarray):
        self.langs, self.log_p, self.writes = langs, log_p, writes

    def score(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Of each word: scores by language (the best is 0), letters, whether
        any language writes its scripts, what was taken off the scores to make
        the best one 0, and n-grams."""
        found, n_langs = Letters(words), len(self.langs)
        total = np.zeros((found.n, n_langs))
        for word, bucket in found.grams():
            p = self.log_p[bucket]
            for k in range(n_langs):
                total[:, k] += np.bincount(word, weights=p[:, k], minlength=found.n)
        word, script = found.scripts()
        letters = np.bincount(word, minlength=found.n)
        able = np.ones((found.n, n_langs), bool)
        for k in range(n_langs):
            able[word[~self.writes[script, k]], k] = False
        known = able.any(1) & (letters > 0)
        score = np.where(able, total / LONGEST_GRAM, -np.inf)
        best = np.where(known, score.max(1, initial=-np.inf), 0)
        score -= best[:, None]
        score[~able] = -1e6
        score[~known] = 0
        grams = sum(np.maximum(found.lengths - n, 0) for n in range(LONGEST_GRAM))
        return score, letters, known, best, grams


def learn(docs: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          smoothing: float = 0.5) -> Model:
    """Fit on all rows where ``learnable`` holds and id, text and language are known."""
    rows = docs.where(learnable).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                                        F.col(lang_col).cast("string").alias("lang")).dropna().select("text", "lang")
    words = (rows.mapInArrow(lean(_word_counts), "lang string, word string, n long")
             .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    found = (words.mapInArrow(lean(_feature_counts), "lang string, feature long, n long")
             .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow())  # buckets x languages at most
    langs = sorted(set(found["lang"].to_pylist()))
    counts, scripts = np.full((BUCKETS, len(langs)), smoothing), np.zeros((len(SCRIPTS) + 1, len(langs)))
    at = np.searchsorted(np.array(langs, object), np.array(found["lang"].to_pylist(), object))
    feature, n = found["feature"].to_numpy(), found["n"].to_numpy()
    gram = feature < BUCKETS
    counts[feature[gram], at[gram]] += n[gram]
    scripts[feature[~gram] - BUCKETS, at[~gram]] += n[~gram]
    return Model(langs, np.log(counts / counts.sum(0)).astype(np.float32), scripts > SCRIPT_SHARE * scripts.sum(0))


def viterbi(texts: list[np.ndarray], scores: np.ndarray, penalty: float) -> list[np.ndarray]:
    """The best language of every word of every text, all texts stepping
    together: longest first, so those still running are always the first ones."""
    lens = np.array([len(x) for x in texts])
    order = np.argsort(-lens, kind="stable")
    longest = int(lens.max(initial=0))
    if not longest:
        return [np.zeros(0, np.int64) for _ in texts]
    running = np.searchsorted(-lens[order], -np.arange(longest), side="left")  # texts longer than t
    base = np.concatenate([[0], np.cumsum(running)])
    word_at = np.empty(base[-1], np.int32)
    for r, i in enumerate(order):
        word_at[base[:lens[i]] + r] = texts[i]
    state = scores[word_at[:running[0]]].astype(np.float64)
    switch, source = np.zeros((base[-1], scores.shape[1]), bool), np.zeros(base[-1], np.int32)
    rows = np.arange(running[0])
    for t in range(1, longest):
        n, at = running[t], slice(base[t], base[t + 1])
        prev = state[:n]
        best = prev.argmax(1)
        other = prev[rows[:n], best][:, None] - penalty
        switch[at], source[at] = prev < other, best
        state[:n] = np.maximum(prev, other) + scores[word_at[at]]
    now, path = state.argmax(1), np.empty(base[-1], np.int32)
    for t in range(longest - 1, -1, -1):
        n, at = running[t], slice(base[t], base[t + 1])
        path[at] = now[:n]
        if t:
            now[:n] = np.where(switch[at][rows[:n], now[:n]], source[at], now[:n])
    out = [None] * len(texts)
    for r, i in enumerate(order):
        out[i] = path[base[:lens[i]] + r]
    return out


class _Words(dict):
    """Row of each word in the score tables; words met since the last
    ``tables()`` are scored together there."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.new = model, []
        self.scored = [model.score([])]

    def __missing__(self, word):
        self[word] = at = len(self)
        self.new.append(word)
        return at

    def tables(self) -> tuple[np.ndarray, ...]:
        for i in range(0, len(self.new), SCORED_AT_ONCE):
            self.scored.append(self.model.score(self.new[i:i + SCORED_AT_ONCE]))
        self.new = []
        self.scored = [tuple(np.concatenate(x) for x in zip(*self.scored))]
        return self.scored[0]


def _labeller(model: Model, penalty: float, text_at: int | None):
    """Of the columns id, text and others; with ``text_at`` of id and a struct
    whose field of that place is the text."""
    langs = model.langs

    def blocks(texts: list[str], words: _Words):
        block, held = [], 0
        for t in texts:
            ids = np.array([words[w] for w in WORD.findall((t or "").lower())], np.int32)
            if block and held + len(ids) > BLOCK_WORDS:
                yield block
                block, held = [], 0
            block.append(ids)
            held += len(ids)
        if block:
            yield block

    def label(batches):
        words = _Words(model)
        for b in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            if len(words) > KNOWN:
                words = _Words(model)
            texts, rest = (b.column(1), 2) if text_at is None else (b.column(1).field(text_at), 1)
            preds, shares, spans, fits, spreads, fitted = [], [], [], [], [], []
            for block in blocks(texts.to_pylist(), words):
                scores, letters, known, best, grams = words.tables()
                paths = viterbi(block, scores, penalty) if langs else [None] * len(block)
                for ids, path in zip(block, paths):
                    own = known[ids] if langs else np.zeros(len(ids), bool)
                    w = ids[own]
                    if len(w):
                        likely = (scores[w, path[own]] + best[w]) * LONGEST_GRAM
                        fits.append(float(likely.sum() / grams[w].sum()))
                        spreads.append(float((likely / grams[w]).var()))
                    else:
                        fits.append(None)
                        spreads.append(None)
                    fitted.append(len(w))
                    n = letters[ids].sum() if len(ids) else 0
                    if not langs or not n:
                        preds.append(UNDETERMINED)
                        shares.append(0.0)
                        spans.append([])
                        continue
                    own = np.bincount(path, weights=letters[ids] * known[ids], minlength=len(langs))
                    top = int(own.argmax())
                    preds.append(langs[top])
                    shares.append(float(own[top] / n))
                    starts = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1, [len(path)]]).tolist()
                    spans.append([{"first": i, "last": j - 1, "lang": langs[path[i]]} for i, j in zip(starts, starts[1:])])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(preds, pa.string()), pa.array(shares, pa.float64()),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())]))),
                 pa.array(fits, pa.float64()), pa.array(spreads, pa.float64()), pa.array(fitted, pa.int64()),
                 *[b.column(i) for i in range(rest, b.num_columns)]],
                names=["id", "lang_pred", "score", "spans", "fit", "spread", "n_fitted", *b.schema.names[rest:]])
    return label


def label_languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    penalty: float = 12.0, payload: bool = False) -> DataFrame:
    """``id``, ``lang_pred``, ``score`` and ``spans`` (first and last word, from
    0, and language of each span); ``fit``, the mean log likelihood of an
    n-gram, each word's in the language of its span, ``spread``, the variance
    of that between words, and ``n_fitted``, the words of learned scripts;
    with ``payload`` the row as struct ``row``."""
    # a text that the row holds as it is travels once
    text_at = docs.columns.index(text_col) if payload and docs.schema[text_col].dataType == T.StringType() else None
    cols = [F.col(id_col).alias("id")]
    if text_at is None:
        cols.append(F.col(text_col).cast("string").alias("text"))
    if payload:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    src = docs.select(*cols)
    others = [f for f in src.schema.fields[1:] if f.name != "text"]
    span = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()),
                         T.StructField("lang", T.StringType())])
    schema = T.StructType([src.schema.fields[0], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span)),
                           T.StructField("fit", T.DoubleType()), T.StructField("spread", T.DoubleType()), T.StructField("n_fitted", T.LongType()),
                           *others])
    return src.mapInArrow(lean(_labeller(model, penalty, text_at)), schema)


def held_out(id_col: str = "doc_id", modulus: int = 5, remainder: int = 0) -> Column:
    """Whether a row's id belongs to the fold that is never learned from; null ids don't."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))


def _quantiles(rows: DataFrame, keys: list[str], value: str, shares: tuple[float, ...]) -> dict[tuple, list[float]]:
    """By group the exact quantiles of ``value``, interpolated between ranks as
    ``percentile`` does. The groups' ranks are found among counts of bins, and
    only the bins that hold a wanted rank are put in order, so no task holds or
    sorts a whole group."""
    rows = rows.select(*keys, F.col(value).alias("v"), F.floor(F.col(value) * FIT_BINS).alias("bin"))
    group = Window.partitionBy(*keys)
    bins = (rows.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
            .withColumn("before", F.sum("n").over(group.orderBy("bin")) - F.col("n")).withColumn("size", F.sum("n").over(group)))
    places = [f((F.col("size") - 1) * F.lit(p)) for p in shares for f in (F.floor, F.ceil)]
    ranks = (bins.withColumn("rank", F.explode(F.array_distinct(F.array(*places))))
             .where("rank >= before AND rank < before + n").select(*keys, "bin", "before", "size", "rank"))
    inside = rows.join(F.broadcast(ranks.select(*keys, "bin", "before").distinct()), [*keys, "bin"])  # two bins a share and group at most
    order = Window.partitionBy(*keys, "bin").orderBy("v")
    counted = inside.groupBy(*keys, "bin", "before", "v").agg(F.count("*").alias("n")).withColumn("last", F.col("before") + F.sum("n").over(order) - 1)
    found = (counted.drop("before").join(ranks, [*keys, "bin"]).where("rank <= last AND rank > last - n")
             .select(*keys, "size", "rank", "v").collect())  # two rows a share and group at most
    at = defaultdict(dict)
    for r in found:
        at[tuple(r[k] for k in keys), r["size"]][r["rank"]] = r["v"]
    out = {}
    for (key, size), v in at.items():
        out[key] = []
        for p in shares:
            place = (size - 1) * p
            low, high = int(np.floor(place)), int(np.ceil(place))
            out[key].append(v[low] if v[low] == v[high] else (high - place) * v[low] + (place - low) * v[high])
    return out


def usual_fit(labelled: DataFrame, lang: Column, least: int = 5) -> dict[str, tuple[float, float, float]]:
    """By language, from all labelled texts that were given their own language:
    median fit, variance between texts (from the lowest twentieth, so a few
    wrong labels don't matter) and between the words of a text. Texts the model
    has not seen, if there are ``least``. ``labelled`` is a result of
    :func:`label_languages`, ``lang`` the rows' label."""
    own = (labelled.select(held_out("id").alias("held"), lang.cast("string").alias("lang"), "lang_pred", "fit", "spread", "id").dropna()
           .where("lang = lang_pred").select("lang", "held", "fit", "spread"))
    words = {(r.lang, r.held): r for r in own.groupBy("lang", "held").agg(F.avg("spread").alias("words"), F.count("*").alias("n")).collect()}
    parts = {}
    for (lang, held), (low, mid) in sorted(_quantiles(own, ["lang", "held"], "fit", (0.05, 0.5)).items()):  # the later ones replace the earlier
        r = words[lang, held]
        if lang not in parts or r.n >= least:
            parts[lang] = (mid, ((mid - low) / 1.645) ** 2, r.words)
    return parts


def drop_rejected(docs: DataFrame, wanted: list[str] | None = None, min_score: float = 0.2, max_deviations: float = 10.0,
                  lang_col: str = "lang", **columns) -> DataFrame:
    """The rows of ``docs``, whole, whose language is determined (and
    ``wanted``, if given), holds at least ``min_score`` of the letters and fits:
    the text's fit is at most ``max_deviations`` standard deviations, for its
    number of words, below what is usual in that language. Texts in a language
    never learned and random letters go by the last condition. The labelled
    rows are written once: the usual fits and the result read them."""
    model = learn(docs, ~held_out(columns.get("id_col", "doc_id")), lang_col=lang_col, **columns)
    found = stored(label_languages(docs, model, payload=True, **columns).drop("spans"), "languages")
    usual = usual_fit(found, F.col(f"row.`{lang_col}`"))
    ok = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score)
    for lang, (mid, texts, words) in usual.items():
        # a rounding error is no deviation
        lowest = mid - max_deviations * F.sqrt(texts + words / F.col("n_fitted")) - 1e-6
        ok &= (F.col("lang_pred") != lang) | (F.col("fit") >= lowest)
    if wanted is not None:
        ok &= F.col("lang_pred").isin(wanted)
    return found.where(ok).select("row.*")
