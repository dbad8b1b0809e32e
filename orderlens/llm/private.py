"""Personal data in texts: fixed patterns, and bootstrapped lexical contexts that find identifiers of other forms.

Everything is DataFrame functions. The base patterns give seed entities: mail addresses, IPv4 addresses, card and phone
numbers. Candidates are runs of tokens with a digit or a mark of an address that no base span touches. Both are
instances, told apart by their normal form (digits of a number, lower case of an address), and both stand in contexts:
the word before, the two words before, and the words before and after. Contexts and instances are the two sides of a
graph. In each round

* the confidence of a context for a kind is the sum of the scores of its distinct instances, divided by their number
  plus one; instances without a score whose form would fit the kind weigh ``DOUBT``, all others are evidence against it;
* a context of at least ``MIN_SUPPORT`` scored instances and ``MIN_CONFIDENCE`` is trusted, and a candidate whose form fits
  gets the score 1 - product of (1 - confidence) over its trusted contexts. Seeds keep the score 1.

After ``ROUNDS`` rounds every occurrence of a candidate with a score of ``MIN_SCORE`` is a span of its best kind, and so is a
candidate with the normal form of a seed (a known phone number written without its plus sign). Distinct instances
count, not rows, so that copies of a document give no confidence.

Base patterns are written so that a long run costs linear time and no deep recursion: a match begins where a run does or
where the last match ended, and repeats are possessive; the matches are those of the plain patterns. Offsets are code
points, end exclusive, from the lengths of matches and of the pieces between them, added up in chunks.

Cases: null text counts as empty and has no spans; repeated rows each keep their row. Rows are told apart by a number
given when the texts are read, once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import materialise

KINDS = ("email", "ip", "card", "phone")

# The base patterns
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MAY_HOLD = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Candidates, and the forms that fit a kind
CANDIDATE = r"(?<!\S)(?=\S*?(?:[0-9@]|\(at\)|\[at\]))\S++(?:\x20\(?[0-9]\S*+)*+"
MAY_BE_CANDIDATE = r"[0-9@]|\(at\)|\[at\]"
ADDRESS = r"^\S+(?:@|\((?i:at)\)|\[(?i:at)\])\S+$"
NUMBER = r"^[+(]?[0-9][0-9().\x20/-]*$"
NO_NUMBER = r"^[0-9]{1,4}(?:[./-][0-9]{1,4}){1,2}$"  # dates, decimal numbers, versions
HOST = r"^[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}$"
FITS = {"email": "address", "ip": "host", "card": "number", "phone": "number"}

ROUNDS, MIN_SUPPORT, MIN_CONFIDENCE, MIN_SCORE, DOUBT = 3, 4, 0.8, 0.8, 0.25
CONTEXT_CHARS = 80
CHUNK = 512


def _prefix(steps: Column) -> Column:
    """Sums of all elements before each; in chunks, as an array grows by copying."""
    zero = F.lit(0).cast("long")

    def running(values: Column, start: Column) -> Column:
        grown = F.aggregate(values, F.array(start), lambda acc, x: F.concat(acc, F.array(F.coalesce(F.element_at(acc, -1) + x, zero))))
        return F.slice(grown, 1, F.size(values))

    chunks = F.transform(F.sequence(F.lit(0), F.expr("0") + F.floor((F.size(steps) - 1) / CHUNK).cast("int")), lambda c: F.slice(steps, c * CHUNK + 1, CHUNK))
    sums = F.transform(chunks, lambda c: F.aggregate(c, zero, lambda acc, x: acc + x))
    both = F.arrays_zip(chunks.alias("chunk"), running(sums, zero).alias("start"))
    return F.flatten(F.transform(both, lambda b: running(b["chunk"], F.coalesce(b["start"], zero))))


def _placed(pieces: Column, found: Column, ends: Column) -> Column:
    def place(m: Column, i: Column) -> Column:
        start = F.get(ends, i) + F.length(F.get(pieces, i))
        return F.struct(
            start.alias("start"), (start + F.length(m)).alias("end"), m.alias("value"),
            F.right(F.get(pieces, i), F.lit(CONTEXT_CHARS)).alias("before"), F.left(F.get(pieces, i + 1), F.lit(CONTEXT_CHARS)).alias("after"),
        )

    return F.transform(found, place)


def _matches(df: DataFrame, text: str, found: dict[str, tuple[str, str]]) -> DataFrame:
    """For each name: the matches of its pattern as (start, end, value, before, after), in order. Columns are built in
    steps, so that no text is searched once for each of its matches."""
    t = F.col(text)
    none = F.array().cast("array<string>")
    for name, (may, pattern) in found.items():
        there = t.rlike(may)
        df = df.withColumns({f"p_{name}": F.when(there, F.split(t, pattern, -1)).otherwise(none), f"m_{name}": F.when(there, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).otherwise(none)})
    steps = {}
    for name in found:
        lengths = F.transform(F.arrays_zip(F.col(f"p_{name}").alias("p"), F.col(f"m_{name}").alias("m")), lambda z: (F.coalesce(F.length(z["p"]), F.lit(0)) + F.coalesce(F.length(z["m"]), F.lit(0))).cast("long"))
        steps[f"s_{name}"] = F.when(F.size(f"m_{name}") > 0, _prefix(lengths))
    df = df.withColumns(steps)
    out = {name: _placed(F.col(f"p_{name}"), F.col(f"m_{name}"), F.col(f"s_{name}")) for name in found}
    return df.withColumns(out).drop(*[f"{c}_{name}" for name in found for c in "pms"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _only_sound(kind: str) -> Column:
    return F.filter(kind, lambda m: _sound(kind, m["value"]))


def _spans_of(number: int) -> Column:
    return F.transform(KINDS[number], lambda m: F.struct(F.lit(number).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))


def _seeds_of(number: int) -> Column:
    kind = KINDS[number]
    return F.transform(kind, lambda m: _instance(F.lit(number), m["start"], m["end"], F.lit(FITS[kind]), m["value"], m))


def _count_of(number: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long").alias(f"n_{KINDS[number]}")


def _sound(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    n = F.length(_digits(value))
    return n.between(16, 19) & F.call_function("luhn_check", _digits(value)) if kind == "card" else n.between(8, 15)


def _words(side: Column) -> Column:
    plain = F.regexp_replace(F.lower(side), "[0-9]", "9")
    return F.filter(F.split(plain, r"\s+"), lambda w: w != "")


def _contexts(before: Column, after: Column) -> Column:
    """Up to three contexts; none without a word before."""
    left, right = _words(before), _words(after)
    one = F.element_at(left, -1)
    made = F.array(
        F.concat(F.lit("l "), one),
        F.when(F.size(left) > 1, F.concat(F.lit("ll "), F.element_at(left, -2), F.lit(" "), one)),
        F.when(F.size(right) > 0, F.concat(F.lit("lr "), one, F.lit(" _ "), F.element_at(right, 1))),
    )
    return F.when(F.size(left) > 0, F.filter(made, lambda c: c.isNotNull())).otherwise(F.array().cast("array<string>"))


def _form(value: Column) -> Column:
    digits = F.length(_digits(value))
    return (
        F.when(value.rlike(ADDRESS), "address").when(value.rlike(HOST), "host")
        .when(value.rlike(NUMBER) & ~value.rlike(NO_NUMBER) & digits.between(6, 19), "number").otherwise("other")
    )


def _key(form: Column, value: Column) -> Column:
    return F.md5(F.concat_ws(":", form, F.when(form == "number", _digits(value)).otherwise(F.lower(value))))


def _instance(kind: Column, start: Column, end: Column, form: Column, value: Column, m: Column) -> Column:
    return F.struct(
        kind.alias("kind"), start.alias("start"), end.alias("end"), form.alias("form"), _key(form, value).alias("key"),
        _contexts(m["before"], m["after"]).alias("contexts"),
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: rid, doc_id, base spans (kind number, start, end) and instances with their contexts."""
    read = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    df = _matches(read, "text", {k: (MAY_HOLD[k], BASE[k]) for k in KINDS} | {"run": (MAY_BE_CANDIDATE, CANDIDATE)}).drop("text")
    df = df.withColumns({k: _only_sound(k) for k in KINDS})
    df = df.withColumn("base", F.concat(*map(_spans_of, range(len(KINDS)))))

    def trimmed(m: Column) -> Column:
        head = F.regexp_replace(m["value"], r"^[^0-9A-Za-z+(@]+", "")
        value = F.regexp_replace(head, r"(?<![^0-9A-Za-z)])[^0-9A-Za-z)]++$", "")
        start = m["start"] + F.length(m["value"]) - F.length(head)
        return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"), m["before"].alias("before"), m["after"].alias("after"))

    df = df.withColumn("run", F.transform("run", trimmed))
    df = df.withColumn("run", F.filter("run", lambda m: m["value"] != ""))
    others = F.transform("run", lambda m: _instance(F.lit(-1), m["start"], m["end"], _form(m["value"]), m["value"], m))
    return df.select("rid", "doc_id", "base", F.concat(*map(_seeds_of, range(len(KINDS))), others).alias("instances"))


def instances_of(rows: DataFrame) -> DataFrame:
    """One row for each instance; candidates that a base span touches are gone."""
    every = rows.select("rid", F.explode("instances").alias("i")).select("rid", "i.*")
    base = F.col("kind") >= 0
    upwards = Window.partitionBy("rid").orderBy("start")
    downwards = Window.partitionBy("rid").orderBy(F.desc("start"))
    marked = every.withColumns({"reach": F.max(F.when(base, F.col("end"))).over(upwards), "next": F.min(F.when(base, F.col("start"))).over(downwards)})
    touched = (F.coalesce("reach", F.lit(0)) > F.col("start")) | (F.coalesce("next", F.col("end")) < F.col("end"))
    return marked.where(base | ~touched).drop("reach", "next")


def _largest(scores: list[str]) -> Column:
    return F.greatest(*[F.col(s) for s in scores])


def discovered(instances: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_score: float = MIN_SCORE) -> DataFrame:
    """(key, found): the kind number of each instance that is a seed or that contexts vouch for."""
    scores = [f"s{i}" for i in range(len(KINDS))]
    seed = {s: F.max(F.when(F.col("kind") == i, 1.0).otherwise(0.0)).alias(s) for i, s in enumerate(scores)}
    state = materialise(instances.groupBy("key").agg(F.min("form").alias("form"), *seed.values(), F.max((F.col("kind") >= 0)).alias("seed")))
    edges = materialise(instances.select("key", F.explode("contexts").alias("context")).distinct())
    for _ in range(rounds):
        known = edges.join(state, "key")
        unscored = _largest(scores) == 0
        counts = known.groupBy("context").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(s).alias(f"sum_{s}") for s in scores], *[F.sum((F.col(s) > 0).cast("int")).alias(f"n_{s}") for s in scores],
            *[F.sum((unscored & (F.col("form") == FITS[k])).cast("int")).alias(f"open_{s}") for k, s in zip(KINDS, scores, strict=True)],
        )
        sure = [F.col(f"sum_{s}") / (F.col("n") - F.col(f"open_{s}") * (1 - DOUBT) + 1) for s in scores]
        trusted = counts.select("context", *[F.when((F.col(f"n_{s}") >= min_support) & (c >= min_confidence), c).otherwise(0.0).alias(f"c_{s}") for s, c in zip(scores, sure, strict=True)])
        trusted = trusted.where(reduce(Column.__or__, [F.col(f"c_{s}") > 0 for s in scores]))
        doubt = edges.join(trusted, "context").groupBy("key").agg(*[F.sum(F.log1p(-F.col(f"c_{s}"))).alias(f"d_{s}") for s in scores])
        vouched = [
            F.when(F.col("seed"), F.col(s)).when(F.col("form") == FITS[k], F.round(1 - F.exp(F.coalesce(f"d_{s}", F.lit(0.0))), 9)).otherwise(0.0).alias(s)
            for k, s in zip(KINDS, scores, strict=True)
        ]
        state = materialise(state.join(doubt, "key", "left").select("key", "form", *vouched, "seed"))
    best = reduce(lambda rest, i: F.when(F.col(scores[i]) == _largest(scores), i).otherwise(rest), reversed(range(len(KINDS))), F.lit(None).cast("int"))
    return state.where(_largest(scores) >= min_score).select("key", best.alias("found"))


def _listed(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (kind:start:end, by kind, then start), n_found."""
    rows = materialise(scan(docs, id_col, text_col))
    instances = materialise(instances_of(rows))
    labels = discovered(instances, **limits)
    more = (
        instances.where("kind < 0 and form <> 'other'").join(labels, "key")
        .groupBy("rid").agg(F.collect_list(F.struct(F.col("found").alias("kind"), "start", "end")).alias("found")).withColumnRenamed("rid", "of_row")
    )
    joined = rows.drop("instances").join(more, F.col("rid") == F.col("of_row"), "left")
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    found = F.coalesce("found", none)
    return joined.select("doc_id", *map(_count_of, range(len(KINDS))), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.array_sort(F.concat("base", found))).alias("spans"), F.size(found).cast("long").alias("n_found"))
