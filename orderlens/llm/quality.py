"""Quality by importance resampling.

Two generative models over hashed n-grams: one of the target text (labelled good and not toxic), one of all raw text. The
n-grams are the words and pairs of words themselves, and pairs of word forms: what a word starts and ends with, its case
and length, and whether it repeats the word before it, so that tables, shouting, symbol runs and stuttering have grams of
their own in any language. A document's importance is the ratio of the two models over its n-grams; documents are then
drawn without replacement in proportion to their importance by Gumbel top-k: noise is added to the log weights and the k
largest stay.

A second ratio, of toxic against clean labelled text, is over documents that hold a word or a pair of words, known by 48
bits. Only those count that toxic text holds more often than chance would give one of so many (a likelihood ratio test
against the number tried), each once in a document, so that neither length nor clean text around it hides a toxic passage.
Its cut parts toxic from clean labelled rows best; documents beyond it take no part in the draw.

log weight = TEMPER * sum / (n + SHRINK): the log ratio of a passage of TEMPER words, so that length does not count;
SHRINK holds short texts near 0. k is the number of documents whose weight passes a cut that parts the labelled rows
best, so the draw keeps as many documents as are good, and noise matters only near the cut.

Bounds: the target model, the toxic model and the cuts use at most ``max_labelled`` labelled rows, taken by the hash of
their id; the toxic model holds at most TOXIC_GRAMS n-grams. The raw model, the weights and the selection cover every row. The k-th largest key is found by counting keys in ranges, which
are narrowed until one holds few; no sort, nothing of the corpus on the driver.

Cases: null and blank texts have no n-grams and weight 0. Without labels of both kinds every row is kept. A toxic document
has no draw. Equal texts count once in the toxic model; an unknown toxic label takes no part in it. Rows with the
same id share their noise. Keys equal to the k-th are all kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import column_names, materialise, text_bytes

BUCKETS, TEMPER, SHRINK, SMOOTH = 4096, 200.0, 30.0, 0.001
WORD_BUCKETS, WORD_SHRINK = 1 << 16, 10.0
TOXIC_GRAMS, TOXIC_LEAST, TOXIC_SHRINK = 100_000, 3, 4.0
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
CACHE_WORDS = 100_000

_forms: dict[bytes, int] = {}


def _kind(c: int) -> int:
    """Lower case, upper case, digit, beyond ASCII, sentence mark, other mark."""
    if 97 <= c <= 122:
        return 0
    if 65 <= c <= 90:
        return 1
    if 48 <= c <= 57:
        return 2
    if c >= 128:
        return 3
    return 4 if c in b".,;:" else 5


def _form(word: bytes) -> int:
    shouted = word.upper() == word and word.lower() != word
    return ((_kind(word[0]) * 6 + _kind(word[-1])) * 2 + shouted) * 5 + min(4, len(word) // 4)


def _words(text: bytes | None) -> np.ndarray:
    """For each word, 48 bits of its lower case without marks around it, and 10 bits of its form."""
    words = text.split() if text else []
    if len(_forms) > CACHE_WORDS:
        _forms.clear()
    for w in set(words).difference(_forms):
        _forms[w] = (xxhash.xxh3_64_intdigest(w.lower().strip(MARKS) or w) >> 16) << 10 | _form(w)
    return np.fromiter(map(_forms.__getitem__, words), np.int64, len(words))


def _spread(x: np.ndarray, bits: int) -> np.ndarray:
    return ((x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def form_grams(v: np.ndarray) -> np.ndarray:
    """The buckets of pairs of forms, one for each word with the word before it."""
    if not len(v):
        return v
    same = np.concatenate([[False], v[1:] == v[:-1]])
    forms = (v & 1023) * 2 + same + 1
    return _spread(np.concatenate([[0], forms[:-1]]) * 2048 + forms, 12)


def word_grams(v: np.ndarray) -> np.ndarray:
    """48 bits for each word and each pair of words."""
    u = (v >> 10).astype(np.uint64)
    return np.concatenate([_spread(u, 48), _spread((u[:-1] * np.uint64(0xBF58476D1CE4E5B9)) ^ (u[1:] + np.uint64(1)), 48)])


def grams(v: np.ndarray) -> np.ndarray:
    """The buckets of forms, then those of words, in one numbering."""
    return np.concatenate([form_grams(v), BUCKETS + (word_grams(v) & (WORD_BUCKETS - 1))])


def _count(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, BUCKETS + WORD_BUCKETS), np.int64)
    for batch in part:
        for text, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = grams(_words(text))
            np.add.at(counts[0], found, 1)
            if target:
                np.add.at(counts[1], found, 1)
    at = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[0][at]), pa.array(counts[1][at])], names=["bucket", "raw", "target"])


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log p(target) - log p(raw) of each bucket; the target model is mixed with a little of the raw one."""
    p = (raw + 1.0) / (raw + 1.0).sum()
    return np.log((1 - SMOOTH) * target / target.sum() + SMOOTH * p) - np.log(p) if target.sum() else np.zeros(len(raw))


def word_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The same for words, most of which are rare: WORD_SHRINK more of each hold a ratio of few near 0."""
    return np.log((target + WORD_SHRINK) / (raw * (target.sum() / raw.sum()) + WORD_SHRINK)) if target.sum() else np.zeros(len(raw))


def _held(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and how many clean documents of a batch hold a gram."""
    for batch in part:
        held: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held[toxic].append(np.unique(word_grams(_words(text))))
        for toxic in (0, 1):
            found, n = np.unique(np.concatenate(held[toxic]), return_counts=True)
            none = np.zeros(len(n), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n if toxic else none), pa.array(none if toxic else n)], names=["gram", "toxic", "clean"])


def toxic_model(known: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Grams that toxic rows of (t, toxic) hold clearly more often than clean ones, ascending, and their log ratios."""
    texts = known.where("toxic is not null").groupBy("t").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    texts = materialise(texts)
    n = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return np.zeros(0, np.int64), np.zeros(0)
    held = texts.select("t", "toxic").mapInArrow(_held, "gram long, toxic long, clean long").groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    held = materialise(held.where(F.col("toxic") + F.col("clean") >= TOXIC_LEAST))
    tried, both, share = held.count(), F.col("toxic") + F.col("clean"), n[1] / (n[0] + n[1])
    like = F.col("clean") * F.lit(n[1] / n[0])
    g2 = 2 * (F.col("toxic") * F.log(F.col("toxic") / (both * share)) + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (both * (1 - share)))).otherwise(0.0))
    more = held.where(F.col("toxic") > like).withColumn("g2", g2).where(F.col("g2") >= 2 * np.log(max(2, tried)))
    ratio = F.log((F.col("toxic") + TOXIC_SHRINK) / (like + TOXIC_SHRINK)).alias("ratio")
    rows = sorted((r["gram"], r["ratio"]) for r in more.orderBy(F.col("g2").desc(), "gram").limit(TOXIC_GRAMS).select("gram", ratio).collect())  # at most TOXIC_GRAMS
    return np.array([g for g, _ in rows], np.int64), np.array([x for _, x in rows], float)


def toxicity(v: np.ndarray, model: np.ndarray, ratios: np.ndarray) -> float:
    """The sum of the ratios of the model's grams that the words hold."""
    if not len(model) or not len(v):
        return 0.0
    found = word_grams(v)
    at = np.minimum(np.searchsorted(model, found), len(model) - 1)
    return float(ratios[np.unique(at[model[at] == found])].sum())


def _weigh(part: Iterator[pa.RecordBatch], text_name: str, ratios: np.ndarray, toxic: tuple[np.ndarray, np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in part:
        at = batch.schema.get_field_index(text_name)
        sizes, weights, bad = [], [], []
        for text in batch.column(at).to_pylist():
            v = _words(text)
            sizes.append(len(v))
            weights.append(TEMPER * float(ratios[grams(v)].sum()) / (len(v) + SHRINK))
            bad.append(toxicity(v, *toxic))
        rest = [batch.column(i) for i in range(batch.num_columns) if i != at]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(sizes, pa.int64()), pa.array(weights, pa.float64()), pa.array(bad, pa.float64())], names=names)


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The middle of the gap that parts good from bad with the highest balanced accuracy."""
    if not good.any() or good.all():
        return -np.inf
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    below_bad = np.concatenate([[0], np.cumsum(~g)]) / (~g).sum()
    above_good = 1 - np.concatenate([[0], np.cumsum(g)]) / g.sum()
    score = below_bad + above_good
    distinct = np.concatenate([[True], w[1:] > w[:-1], [True]])
    at = int(np.where(distinct, score, -1).argmax())
    low, high = w[max(0, at - 1)], w[min(len(w) - 1, at)]
    return float((low + high) / 2)


def kth_largest(df: DataFrame, key: str, k: int, few: int = 5000, bins: int = 1024) -> float:
    """The k-th largest value of a column by counting in ever narrower ranges."""
    low, high = df.select(F.min(key), F.max(key)).first()
    above = 0
    while True:
        width = (high - low) / bins
        if width <= 0 or low + width == low:
            return low
        rank = F.least(F.floor((F.col(key) - F.lit(low)) / F.lit(width)).cast("int"), F.lit(bins - 1))
        inside = df.where(F.col(key).between(low, high)).select(F.col(key).alias("v"), rank.alias("bin"))
        counts = sorted(((r["bin"], r["n"], r["low"], r["high"]) for r in inside.groupBy("bin").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()), reverse=True)  # at most `bins` rows
        for _, n, a, b in counts:
            if above + n >= k:
                break
            above += n
        if a == b:
            return a
        if n <= few:
            held = sorted((r["v"] for r in inside.where(F.col("v").between(a, b)).collect()), reverse=True)  # at most `few` rows
            return held[k - above - 1]
        low, high = a, b


def resample(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with n_grams, log_weight, draw (log weight plus noise) and kept; the stored table is scanned once more
    for ``kept``, no row is joined."""
    added = ["n_grams", "log_weight", "draw", "kept"]
    docs = docs.drop(*(c for c in docs.columns if c.lower() in added))
    flags = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("good"), F.max("toxic").alias("toxic"))
    sample = materialise(flags.where("good is not null or toxic is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    clean = F.coalesce("toxic", F.lit(0)) == 0
    known = F.broadcast(sample.select(F.col("doc_id").alias("labelled"), ((F.col("good") == 1) & clean).alias("target"), F.when(clean, F.col("good") == 1).alias("good"), "toxic"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("t")).join(known, F.col("id") == F.col("labelled"), "left")
    counts = texts.select("t", F.coalesce("target", F.lit(False)).alias("target")).mapInArrow(_count, "bucket long, raw long, target long")
    model = np.zeros((2, BUCKETS + WORD_BUCKETS))
    for r in counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():  # at most the buckets
        model[:, r["bucket"]] = r["raw"], r["target"]
    ratios = np.concatenate([log_ratios(*model[:, :BUCKETS]), word_ratios(*model[:, BUCKETS:])])
    toxic = toxic_model(texts.where("labelled is not null").select("t", "toxic"))
    names = column_names(docs, ["text_utf8", "toxicity"])
    text, bad = names["text_utf8"], names["toxicity"]
    given = docs.withColumn(text, text_bytes(text_col))
    fields = [*docs.schema.fields, T.StructField("n_grams", T.LongType()), T.StructField("log_weight", T.DoubleType()), T.StructField(bad, T.DoubleType())]
    weighed = materialise(given.mapInArrow(partial(_weigh, text_name=text, ratios=ratios, toxic=toxic, names=[f.name for f in fields]), T.StructType(fields)))
    fit = weighed.select(F.col(id_col).cast("long").alias("id"), "log_weight", F.col(bad).alias("bad")).join(known, F.col("id") == F.col("labelled")).select("log_weight", "bad", "good", "toxic").limit(4 * max_labelled).collect()

    def parted(value: str, flags: list) -> float:
        rows = [(r[value], f) for r, f in zip(fit, flags, strict=True) if f is not None]
        return best_cut(np.array([w for w, _ in rows], float), np.array([f for _, f in rows], bool))

    worst = parted("bad", [None if r["toxic"] is None else r["toxic"] > 0 for r in fit])
    # a cut of -inf: no labels of both kinds
    sound = F.lit(True) if worst == -np.inf or not len(toxic[0]) else F.col(bad) < F.lit(worst)
    cut = parted("log_weight", [r["good"] for r in fit])
    uniform = (F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    weighed = weighed.withColumn("draw", F.when(sound, F.col("log_weight") - F.log(-F.log(uniform)))).drop(bad)
    k = weighed.where((F.col("log_weight") >= F.lit(cut)) & F.col("draw").isNotNull()).count()
    last = kth_largest(weighed, "draw", k) if k else float("inf")
    return weighed.withColumn("kept", F.coalesce(F.col("draw") >= F.lit(last), F.lit(False)))
