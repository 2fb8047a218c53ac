"""URL filters: a bit-parallel automaton that runs all glob rules at once over each URL.

Rules are globs over the canonical form of a URL, which is ``.`` and its host in lower
case, then its path. ``*`` stands for any characters but ``/``, ``**`` for any characters and
``?`` for one character but ``/``. All globs lie side by side in one state of as many 64-bit
words as they need; one step of the automaton shifts the state, keeps what the next byte
allows and leaves set what stands before a wildcard.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import QUERIES, mapped, table

_SLASH = ord("/")
_UPPER = {i: i + 32 for i in range(65, 91)}


@dataclass(frozen=True)
class Rule:
    """``name`` is what a result shows, ``verdict`` what it says and ``glob`` what has to match."""

    name: str
    verdict: str
    glob: str


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host with its subdomains and all paths that start with ``path``."""

    def literal(text: str) -> str:
        return "".join(f"\\{c}" if c in "*?\\" else c for c in text)

    return Rule(f"{host}{path}", verdict, f"*.{literal(host)}{literal(path)}**")


def _symbols(glob: str) -> list[bytes | str]:
    """The glob as single bytes and the wildcards ``*``, ``**`` and ``?``."""
    found: list[bytes | str] = []
    i = 0
    while i < len(glob):
        if glob[i] == "\\" and i + 1 < len(glob):
            found += [bytes([b]) for b in glob[i + 1].encode()]
            i += 2
        elif glob[i] == "*":
            wide = glob[i : i + 2] == "**"
            found.append("**" if wide else "*")
            i += 1 + wide
        elif glob[i] == "?":
            found.append("?")
            i += 1
        else:
            found += [bytes([b]) for b in glob[i].encode()]
            i += 1
    return found


class Automaton:
    """Masks of all globs: bit by bit a start state and one state for each symbol."""

    def __init__(self, globs: Sequence[str]):
        enter: list[np.ndarray] = []  # for each state the bytes that lead into it
        stay: list[np.ndarray] = []  # and those that leave it set
        starts, accepts = [], []
        no_slash = np.ones(256, bool)
        no_slash[_SLASH] = False
        for glob in globs:
            starts.append(len(enter))
            enter.append(np.zeros(256, bool))
            stay.append(np.zeros(256, bool))
            for symbol in _symbols(glob):
                if symbol == "**":
                    stay[-1] = np.ones(256, bool)
                elif symbol == "*":
                    stay[-1] = stay[-1] | no_slash
                else:
                    enter.append(no_slash if symbol == "?" else np.arange(256) == symbol[0])
                    stay.append(np.zeros(256, bool))
            accepts.append(len(enter) - 1)
        self.words = max(1, -(-len(enter) // 64))
        self.enter, self.stay = self._packed(enter), self._packed(stay)
        self.start = np.zeros(self.words, np.uint64)
        for i in starts:
            self.start[i // 64] |= np.uint64(1 << (i % 64))
        self.accepts = accepts

    def _packed(self, rows: list[np.ndarray]) -> np.ndarray:
        """Masks by word and byte."""
        masks = np.zeros((self.words, 256), np.uint64)
        for i, row in enumerate(rows):
            masks[i // 64, row] |= np.uint64(1 << (i % 64))
        return masks

    def matches(self, texts: Sequence[bytes]) -> np.ndarray:
        """Which globs (columns) match which texts (rows) from end to end."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-sizes, kind="stable")
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = (np.cumsum(sizes) - sizes)[order]
        lengths = sizes[order]
        state = np.repeat(self.start[:, None], len(texts), axis=1)
        one, top = np.uint64(1), np.uint64(63)
        # Texts lie from long to short, so those still running are always the first ones.
        running = np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=0))), side="left")
        for step, n in enumerate(running):
            byte = data[offsets[:n] + step]
            now = state[:, :n]
            shifted = now << one
            shifted[1:] |= now[:-1] >> top
            state[:, :n] = (shifted & self.enter[:, byte]) | (now & self.stay[:, byte])
        found = np.empty((len(texts), len(self.accepts)), bool)
        for k, i in enumerate(self.accepts):
            found[order, k] = (state[i // 64] >> np.uint64(i % 64)) & one
        return found


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case and path; both empty without ``://``."""
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    ends = [i for i in (rest.find(c) for c in "?#") if i >= 0]
    rest = rest[: min(ends)] if ends else rest
    cut = rest.find("/")
    host, path = (rest, "") if cut < 0 else (rest[:cut], rest[cut:])
    return host.translate(_UPPER), path


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], url: str = "url", key: str = "page_id", default: str = "allow"
) -> DataFrame:
    """Each page's key, ``host``, ``path``, the ``rule`` that decides and its ``verdict``.

    Of the rules that match, the one with the longest name decides, and of equally long ones
    the first given. Pages that no rule matches get ``default`` and a null rule. A null URL and
    one without ``://`` have empty host and path. Rows are judged one by one: repeated rows
    and null keys come back as often as they are there; other columns are not read.
    """
    ranked = sorted(rules, key=lambda r: -len(r.name))
    names, verdicts = [r.name for r in ranked] + [None], [r.verdict for r in ranked] + [default]
    automaton = Automaton([r.glob for r in ranked])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            matched = automaton.matches([f".{h}{p}".encode() for h, p in parts])
            hit = np.where(matched.any(axis=1), matched.argmax(axis=1), len(ranked)) if ranked else [0] * len(parts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([h for h, _ in parts], pa.string()),
                    pa.array([p for _, p in parts], pa.string()),
                    pa.array([names[i] for i in hit], pa.string()),
                    pa.array([verdicts[i] for i in hit], pa.string()),
                ],
                names=[key, "host", "path", "rule", "verdict"],
            )

    chosen = pages.select(F.col(key), F.col(url).cast("string").alias("url"))
    kind = chosen.schema[0].dataType.simpleString()
    return mapped(chosen, judge, f"`{key}` {kind}, host string, path string, rule string, verdict string")


#: The rules of the query's contract.
CONTRACT_RULES = (
    host_rule("allow", "com", "/"),
    host_rule("block", "example.com", "/en/"),
    host_rule("allow", "www.example.com", "/en/"),
    host_rule("block", "net", "/es/"),
    host_rule("block", "net", "/fr/"),
)


def _sql() -> str:
    ranked = sorted(CONTRACT_RULES, key=lambda r: -len(r.name))
    cases = {"name": "", "verdict": ""}
    for rule in ranked:
        host, slash, path = rule.name.partition("/")
        fits = f"WHEN ends_with('.' || host, '.{host}') AND starts_with(path, '{slash}{path}')"
        for column in cases:
            cases[column] += f" {fits} THEN '{getattr(rule, column)}'"
    upper = "".join(map(chr, range(65, 91)))
    return f"""
    WITH rest AS (
      SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
      FROM pages),
    parts AS (
      SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS host,
             regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
      FROM rest),
    lowered AS (SELECT page_id, translate(host, '{upper}', '{upper.lower()}') AS host, path FROM parts)
    SELECT page_id, host, path, CASE{cases['name']} END AS rule, CASE{cases['verdict']} ELSE 'allow' END AS verdict
    FROM lowered"""


@QUERIES.add("op7_url_filters", _sql())
def url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), CONTRACT_RULES)
