"""URL filter: rules by host and path, then a weighted vocabulary counted by an Aho-Corasick automaton.

A term counts where no letter or digit touches it on either side. One strict term rejects; so do soft terms, once enough
different ones are there and their weights reach the limit. A rule decides before the vocabulary: it holds for its host
and all its subdomains, where the path starts with the rule's path; the longest rule wins.

Cases: a null url, or one without ://, has an empty host and path, fits no rule and is judged by its terms alone (null:
none, so it is allowed). Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Terms that reject alone, and terms with weights that reject together.
STRICT = ("adult", "casino", "cialis", "escort", "gambling", "hentai", "malware", "phishing", "poker", "porn", "porno", "sex", "spam", "torrent", "viagra", "warez", "xxx")
SOFT = {
    "ads": 1.0, "adserver": 1.0, "banner": 0.5, "bet": 1.0, "bets": 1.0, "bonus": 0.5, "cheap": 1.0, "click": 0.5, "coupon": 0.5, "deal": 0.5, "deals": 0.5, "discount": 0.5,
    "farm": 0.5, "free": 1.0, "jackpot": 1.0, "loan": 1.0, "loans": 1.0, "pharmacy": 1.0, "pill": 1.0, "pills": 1.0, "promo": 0.5, "slots": 1.0, "track": 1.0, "tracker": 1.0, "tracking": 1.0, "win": 1.0, "winner": 1.0,
}
SOFT_LIMIT, SOFT_DISTINCT = 2.0, 2

_LOWER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((at for c in "?#" if (at := rest.find(c)) >= 0), default=len(rest))
    host, slash, path = rest[:end].partition("/")
    return host.translate(_LOWER), slash + path


class Rules:
    def __init__(self, block: tuple[str, ...], allow: tuple[str, ...]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rules in (("block", block), ("allow", allow)):
            for rule in rules:
                host, slash, path = rule.partition("/")
                self.by_host.setdefault(host, []).append((slash + path, rule, verdict))

    def judge(self, host: str, path: str) -> tuple[str | None, str | None]:
        best, verdict, at = None, None, 0
        while host:
            for start, rule, said in self.by_host.get(host[at:], ()):
                if path.startswith(start) and (best is None or len(rule) > len(best)):
                    best, verdict = rule, said
            at = host.find(".", at) + 1
            if not at:
                break
        return best, verdict


class Vocabulary:
    def __init__(self, strict, soft: dict[str, float]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for term in strict:
            self.automaton.add_word(term, (term, None))
        for term, weight in soft.items():
            self.automaton.add_word(term, (term, weight))
        self.automaton.make_automaton()

    def count(self, text: str) -> tuple[int, dict[str, float]]:
        """Strict hits, and the weight of each soft term that occurs."""
        strict, soft = 0, {}
        for end, (term, weight) in self.automaton.iter(text):
            before, after = end - len(term), end + 1
            if (before >= 0 and text[before].isalnum()) or (after < len(text) and text[after].isalnum()):
                continue
            if weight is None:
                strict += 1
            else:
                soft[term] = weight
        return strict, soft


def _judge(part: Iterator[pa.RecordBatch], url_name: str, block, allow, strict, soft, names) -> Iterator[pa.RecordBatch]:
    rules, vocabulary = Rules(block, allow), Vocabulary(strict, soft)
    for batch in part:
        out = []
        for url in batch.column(batch.schema.get_field_index(url_name)).to_pylist():
            host, path = split_url(url)
            rule, verdict = rules.judge(host, path)
            hits, found = vocabulary.count((url or "").translate(_LOWER))
            weight = sum(found.values())
            rejected = hits > 0 or (len(found) >= SOFT_DISTINCT and weight >= SOFT_LIMIT)
            out.append((host, path, rule, verdict or ("block" if rejected else "allow"), hits, len(found), weight))
        columns = list(zip(*out, strict=True)) if out else [()] * 7
        types = [pa.string()] * 4 + [pa.int64()] * 2 + [pa.float64()]
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=names)


def judge_urls(pages: DataFrame, block=(), allow=(), strict=STRICT, soft=SOFT, url_col: str = "url") -> DataFrame:
    """The input with host, path, rule, verdict, strict_hits, soft_hits (different ones) and soft_weight."""
    added = [("host", T.StringType()), ("path", T.StringType()), ("rule", T.StringType()), ("verdict", T.StringType()), ("strict_hits", T.LongType()), ("soft_hits", T.LongType()), ("soft_weight", T.DoubleType())]
    pages = pages.drop(*(c for c in pages.columns if c.lower() in {n for n, _ in added} and c != url_col)).withColumn(url_col, F.col(url_col).cast("string"))
    schema = T.StructType([*pages.schema.fields, *(T.StructField(n, t) for n, t in added)])
    judge = partial(_judge, url_name=url_col, block=tuple(block), allow=tuple(allow), strict=tuple(strict), soft=dict(soft), names=[f.name for f in schema])
    return pages.mapInArrow(judge, schema)
