"""Personal data: fixed patterns, and identifiers that bootstrapped contexts discover.

What the fixed patterns find are the seeds. Every token that looks like an identifier, seed or not, is an
instance; the word before it, the word after it, and both together are the lexical patterns it stands in,
each scored on its own. How an instance is written plays no part but for one coarse class: whether it has
an at sign, in any writing. Patterns and instances form a graph that Spark scores round by round: a pattern
is as sure as the instances in it, an instance as sure as the patterns it stands in. Patterns that many
documents hold and that score high discover the other identifiers in them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import QUERIES, mapped, table
from graphloom.sources.scratch import written

KINDS = ("email", "ip", "card", "phone")
#: Rounds of scoring, the least score of a pattern that is trusted, and the documents it has to be in.
ROUNDS, MIN_SCORE, MIN_DOCS = 3, 0.9, 5

# The forms of the base kinds. The possessive quantifiers and the look-behind only
# keep long runs from being read again and again; what matches is the same.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Identifier-like tokens. An address has an at sign, also a spelled one, and needs no digit; a number may
# hold blanks, brackets and a leading plus; any other run has a digit, and all have at least six characters.
_HOST = r"[\w-]++(?:\.[\w-]++|\s?[(\[{]\s?dot\s?[)\]}]\s?[\w-]++|\sdot\s[\w-]++)"
_TOKEN = re.compile(
    rf"(?P<mail>(?<![\w.%+-])[\w.%+-]++(?:(?:@|\s?[(\[{{]\s?at\s?[)\]}}]\s?){_HOST}*+|\sat\s{_HOST}++))"
    r"|(?<![^\W_])[+(]{0,2}[0-9](?:[ \u00a0().\u2011\u2013/-]*+[0-9])++(?![-._%+@]*[^\W_])"
    r"|[A-Za-z0-9][A-Za-z0-9@._%+-]{4,}[A-Za-z0-9]",
    re.IGNORECASE,
)
_WORD_BEFORE = re.compile(r"([^\W\d_]+)\W*$")
_WORD_AFTER = re.compile(r"\W*([^\W\d_]+)")
_DIGITS = re.compile("[^0-9]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield Span("email", start, done)
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[Span]:
    """Spans of the base kinds in code points, by kind and then by start."""
    found = list(_emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append(Span("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m.group()) if m.end() - m.start() >= 16 else ""
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(Span("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.sub("", m.group())) <= 15:
                found.append(Span("phone", m.start(), m.end()))
    return found


def _tokens(text: str, base: list[Span]) -> Iterator[tuple[int, int, str]]:
    """Identifier-like tokens that lie between the base spans, with their class."""
    begin = 0
    for start, end in [*sorted((s.start, s.end) for s in base), (len(text), len(text))]:
        if begin < start:
            for m in _TOKEN.finditer(text, begin, start):
                token = m.group()
                # What touches a base span is a part of a longer run.
                apart = (m.start() > begin or not begin) and (m.end() < start or start == len(text))
                mail = m["mail"] is not None or "@" in token
                if apart and len(token) >= 6 and (mail or any(c.isdigit() for c in token)):
                    yield m.start(), m.end(), "@" if mail else "#"
        begin = max(begin, end)


def instances(text: str, base: list[Span]) -> list[tuple[str, str, str | None, int, int]]:
    """Identifier-like tokens as (pattern, instance, kind of a seed or None, start, end), once for each pattern."""
    found = [(s.start, s.end, "@" if s.kind == "email" else "#", s.kind) for s in base]
    found += [(*t, None) for t in _tokens(text, base)]
    out = []
    for start, end, sign, kind in found:
        # Words are short, so the neighbourhood that is looked at is as well.
        before = _WORD_BEFORE.search(text, max(0, start - 40), start)
        after = _WORD_AFTER.match(text, end, end + 40)
        left, right = before[1].lower() if before else "", after[1].lower() if after else ""
        token = text[start:end].lower()
        contexts = [f"{left}|"] * bool(left) + [f"|{right}"] * bool(right) + [f"{left}|{right}"] * bool(left and right)
        out += [(f"{sign} {context}", token, kind, start, end) for context in contexts]
    return out


def found_in(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` without their text, as ``row``, with a number, base spans and instances."""
    rest = [F.col(c) for c in docs.columns if c != text]
    number = F.monotonically_increasing_id().alias("number")
    rows = docs.select(number, F.struct(*rest).alias("row"), F.col(text).cast("string").alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        instance = pa.struct([("pattern", pa.string()), ("instance", pa.string()), *span])
        for batch in batches:
            spans, seen = [], []
            for cell in batch.column(2):
                value = cell.as_py() or ""
                base = base_spans(value)
                spans.append([s._asdict() for s in base])
                seen.append([dict(zip(("pattern", "instance", "kind", "start", "end"), i)) for i in instances(value, base)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(spans, pa.list_(span)), pa.array(seen, pa.list_(instance))],
                names=["number", "row", "spans", "instances"],
            )

    span = "kind string, start bigint, `end` bigint"
    schema = (
        f"number bigint, row {rows.schema['row'].dataType.simpleString()}, spans array<struct<{span}>>, "
        f"instances array<struct<pattern string, instance string, {span}>>"
    )
    return mapped(rows, find, schema)


def score_patterns(seen: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``pattern``, ``kind``, ``score`` and ``docs`` of every pattern that a seed's evidence reaches.

    ``seen`` has a row per occurrence: number of the document, pattern, instance, kind of a seed
    or null. A pattern's score for a kind is the mean of its different instances' scores; an instance
    that is no seed is as sure as the most certain of its patterns, times a damping factor, so
    that evidence fades with its distance from the seeds.
    """
    edges = written(
        seen.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"), F.count("*").alias("times")), "pattern-edges"
    )
    support = seen.select("pattern", "number").distinct().groupBy("pattern").agg(F.count("*").alias("docs"))
    size = edges.groupBy("pattern").agg(F.count("*").alias("instances"))
    seeds = edges.where(F.col("kind").isNotNull()).groupBy("instance", "kind").agg(F.lit(1.0).alias("score"))
    certain = seeds
    for step in range(rounds):
        reached = edges.select("pattern", "instance").join(certain, "instance")
        summed = reached.groupBy("pattern", "kind").agg(F.sum("score").alias("sum"))
        scores = written(
            summed.join(size, "pattern").select("pattern", "kind", (F.col("sum") / F.col("instances")).alias("score")),
            f"pattern-scores-{step}",
        )
        spread = edges.where(F.col("kind").isNull()).select("pattern", "instance").join(scores, "pattern")
        learned = spread.groupBy("instance", "kind").agg((F.lit(0.95) * F.max("score")).alias("score"))
        certain = seeds.unionByName(learned)
    return scores.join(support, "pattern")


def personal_data(docs: DataFrame, text: str = "text", min_score: float = MIN_SCORE, min_docs: int = MIN_DOCS) -> DataFrame:
    """Each row of ``docs`` without its text, as ``row``, with ``base`` and ``discovered`` spans.

    Spans are structs (kind, start, end) in code points with the end left out, in the order of the
    kinds and then of their starts. Discovered spans have the kind of the pattern they stand in
    and never overlap base ones. Null and empty texts have none. Rows are read one by one, repeated
    ones and null ids included.
    """
    found = written(found_in(docs, text), "personal-data")
    seen = found.select("number", F.inline("instances"))
    trusted = (
        score_patterns(seen)
        .where((F.col("score") >= min_score) & (F.col("docs") >= min_docs))
        .groupBy("pattern")
        .agg(F.max(F.struct("score", "kind")).alias("best"))
    )
    # Of the patterns that a token stands in the surest gives the kind.
    new = seen.where(F.col("kind").isNull()).select("pattern", "number", "start", "end").join(trusted, "pattern")
    of_token = new.groupBy("number", "start", "end").agg(F.max("best")["kind"].alias("as_kind"))
    # The spans of one document are bounded by its text.
    span = F.struct(F.col("as_kind").alias("kind"), "start", "end")
    by_row = of_token.groupBy("number").agg(F.sort_array(F.collect_list(span)).alias("new"))
    joined = found.select("number", "row", "spans").join(by_row, "number", "left")
    none = F.array().cast(joined.schema["new"].dataType)
    return joined.select("row", F.col("spans").alias("base"), F.coalesce("new", none).alias("discovered"))


def _digest(spans: Column) -> Column:
    """Spans as kind:start:end, by kind as listed and then by start."""
    order = F.array(*map(F.lit, KINDS))
    ranked = F.transform(
        spans,
        lambda s: F.struct(
            F.array_position(order, s["kind"]).alias("rank"), *[s[c].alias(c) for c in ("start", "end", "kind")]
        ),
    )
    return F.array_join(F.transform(F.array_sort(ranked), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


@QUERIES.add("op10_personal_data")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    counts = [_count(k).alias(f"n_{k}") for k in KINDS]
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *counts,
        F.sha2(_digest(F.col("base")), 256).alias("base_sha256"),
        _digest(F.concat("base", "discovered")).alias("spans"),
        F.size("discovered").cast("long").alias("n_discovered"),
    )
