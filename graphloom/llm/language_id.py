"""Language ID by a bidirectional gated recurrent network over bytes.

The network reads a text as stretches of bytes, once forwards and once backwards, and labels every
position from both states; the probabilities at the positions of letters are pooled into the document's.
It is trained by backpropagation through time, in numpy on the driver, on a bounded sample of
stretches; predictions are made in the tasks, a thousand stretches at a time, over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import QUERIES, groups, mapped, table, text_bytes

#: Bytes of a stretch and state of each direction.
STRETCH, HIDDEN = 64, 8
#: The sample that is trained on: documents for each language, and stretches of each.
FIT_DOCS, FIT_STRETCHES = 800, 4
STEPS, BATCH = 450, 256
UNKNOWN = "und"

_PAD = 256  # stands after the end of a text
_AT_ONCE = 1024


def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    letter = np.zeros(257, bool)
    letter[65:91] = letter[97:123] = letter[0x80:256] = True
    return lower, letter


_LOWER, _LETTER = _alphabet()


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with the capitals of ASCII and of the letters after C3 made small."""
    out = _LOWER[data]
    accented = np.flatnonzero(data[:-1] == 0xC3) + 1 if len(data) else np.empty(0, np.int64)
    accented = accented[(data[accented] >= 0x80) & (data[accented] <= 0x9E) & (data[accented] != 0x97)]
    out[accented] += 0x20
    return out


def stretches(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts cut into stretches, one row each with pads at the end, and the text of each."""
    sizes = np.diff(bounds)
    counts = -(-sizes // STRETCH)
    text = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(text)) - (np.cumsum(counts) - counts)[text]
    start = bounds[:-1][text] + number * STRETCH
    place = start[:, None] + np.arange(STRETCH)
    inside = place < bounds[1:][text][:, None]
    rows = np.full(place.shape, _PAD, np.int16)
    rows[inside] = data[place[inside]]
    return rows, text


@dataclass
class Direction:
    """Weights of one reading direction: of bytes, and of the state for gates and candidate."""

    byte: np.ndarray  # 3 HIDDEN x 257: update gate, reset gate, candidate
    gates: np.ndarray  # 2 HIDDEN x HIDDEN
    candidate: np.ndarray  # HIDDEN x HIDDEN

    @classmethod
    def new(cls, rng: np.random.Generator) -> Direction:
        scale = HIDDEN**-0.5
        made = cls(
            rng.normal(0, 0.3, (3 * HIDDEN, 257)).astype("f"),
            rng.normal(0, 0.2 * scale, (2 * HIDDEN, HIDDEN)).astype("f"),
            rng.normal(0, scale, (HIDDEN, HIDDEN)).astype("f"),
        )
        made.byte[: 2 * HIDDEN] *= 0.2
        made.byte[: 2 * HIDDEN] += 0.5  # gates start half open
        return made

    def states(self, rows: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States after each step, steps x HIDDEN x stretches; gates are linear between 0 and 1."""
        steps, n = rows.shape
        out = np.empty((steps, HIDDEN, n), "f")
        state = np.zeros((HIDDEN, n), "f")
        for t in range(steps):
            from_byte = np.take(self.byte, rows[t], axis=1, mode="clip")
            opened = from_byte[: 2 * HIDDEN] + self.gates @ state
            gate = np.clip(opened, 0, 1)
            update, reset = gate[:HIDDEN], gate[HIDDEN:]
            kept = reset * state
            new = np.tanh(self.candidate @ kept + from_byte[2 * HIDDEN :])
            if trace is not None:
                trace.append((state, opened, gate, kept, new))
            np.multiply(update, new - state, out=out[t])
            out[t] += state
            state = out[t]
        return out

    def gradients(self, rows: np.ndarray, trace: list, d_out: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weights, from those of the states, back through all steps."""
        d_gates, d_candidate = np.zeros_like(self.gates), np.zeros_like(self.candidate)
        d_byte = np.empty((len(rows), 3 * HIDDEN, rows.shape[1]), "f")
        d_state = np.zeros_like(d_out[0])
        for t in range(len(rows) - 1, -1, -1):
            state, opened, gate, kept, new = trace[t]
            update, reset = gate[:HIDDEN], gate[HIDDEN:]
            d = d_out[t] + d_state
            d_new = d * update * (1 - new * new)
            d_kept = self.candidate.T @ d_new
            d_gate = np.concatenate([d * (new - state), d_kept * state]) * ((opened > 0) & (opened < 1))
            d_state = d * (1 - update) + d_kept * reset + self.gates.T @ d_gate
            d_gates += d_gate @ state.T
            d_candidate += d_new @ kept.T
            d_byte[t] = np.concatenate([d_gate, d_new])
        flat = rows.ravel()
        order = np.argsort(flat, kind="stable")
        seen, first = np.unique(flat[order], return_index=True)
        d_table = np.zeros_like(self.byte)
        by_place = d_byte.transpose(1, 0, 2).reshape(3 * HIDDEN, -1)[:, order]
        d_table[:, seen] = np.add.reduceat(by_place, first, axis=1)
        return [d_table, d_gates, d_candidate]


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # languages x (2 HIDDEN + 1)
    _moments: list = field(default_factory=list, repr=False)

    @classmethod
    def new(cls, languages: list[str], seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        out = rng.normal(0, 0.3, (len(languages), 2 * HIDDEN + 1)).astype("f")
        return cls(list(languages), Direction.new(rng), Direction.new(rng), out)

    def _weights(self) -> list[np.ndarray]:
        return [w for d in (self.forward, self.backward) for w in (d.byte, d.gates, d.candidate)] + [self.out]

    def probabilities(self, steps: np.ndarray, traces: tuple[list | None, list | None] = (None, None)) -> tuple:
        """For each step, language and stretch; and the states of both directions."""
        ahead = self.forward.states(steps, traces[0])
        back = self.backward.states(steps[::-1], traces[1])[::-1]
        logits = np.matmul(self.out[:, :HIDDEN], ahead) + np.matmul(self.out[:, HIDDEN : 2 * HIDDEN], back)
        logits += self.out[:, -1:]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits, ahead, back

    def train(
        self, rows: np.ndarray, label: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = 0.02, seed: int = 5
    ) -> float:
        """Fit to stretches and their languages by Adam; returns the last mean loss."""
        rng = np.random.default_rng(seed)
        self._moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self._weights()]
        loss = 0.0
        for step in range(1, steps + 1):
            chosen = rng.integers(0, len(rows), batch)
            at, y = np.ascontiguousarray(rows[chosen].T).astype(np.intp), label[chosen]
            traces: tuple[list, list] = ([], [])
            p, ahead, back = self.probabilities(at, traces)
            weight = (_LETTER[at] / max(1, _LETTER[at].sum())).astype("f")
            now = float(-(np.log(p[:, y, np.arange(batch)] + 1e-9) * weight).sum())
            loss = now if step == 1 else 0.95 * loss + 0.05 * now
            d = p
            d[:, y, np.arange(batch)] -= 1
            d *= weight[:, None, :]
            d_out = np.empty_like(self.out)
            flat = d.transpose(1, 0, 2).reshape(len(self.out), -1)
            d_out[:, :HIDDEN] = flat @ ahead.transpose(0, 2, 1).reshape(-1, HIDDEN)
            d_out[:, HIDDEN : 2 * HIDDEN] = flat @ back.transpose(0, 2, 1).reshape(-1, HIDDEN)
            d_out[:, -1] = flat.sum(axis=1)
            found = self.forward.gradients(at, traces[0], np.matmul(self.out[:, :HIDDEN].T, d))
            found += self.backward.gradients(at[::-1], traces[1], np.matmul(self.out[:, HIDDEN : 2 * HIDDEN].T, d)[::-1])
            self._update([*found, d_out], step, rate * (1 - 0.9 * step / steps))
        return loss

    def _update(self, gradients: list[np.ndarray], step: int, rate: float) -> None:
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in gradients)))
        shrink = min(1.0, 1.0 / max(norm, 1e-9))
        for w, g, (mean, square) in zip(self._weights(), gradients, self._moments):
            g = g * shrink
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            w -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)

    def pooled(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text: the sums over its letters of all languages' probabilities, how many letters'
        own label each language is, and the number of letters."""
        data, bounds = text_bytes(column)
        rows, text = stretches(lowered(data), bounds)
        n = len(self.languages)
        sums, own = np.zeros((len(column), n)), np.zeros((len(column), n), np.int64)
        letters = np.zeros(len(column), np.int64)
        for start in range(0, len(rows), _AT_ONCE):
            part = np.ascontiguousarray(rows[start : start + _AT_ONCE].T).astype(np.intp)
            of = text[start : start + _AT_ONCE]
            p, _, _ = self.probabilities(part)
            weight = _LETTER[part]
            letters += np.bincount(of, weights=weight.sum(axis=0), minlength=len(column)).astype(np.int64)
            best = p.max(axis=1)
            for k in range(n):
                mass = (p[:, k] * weight).sum(axis=0)
                sums[:, k] += np.bincount(of, weights=mass, minlength=len(column))
                mine = ((p[:, k] == best) & weight).sum(axis=0)
                own[:, k] += np.bincount(of, weights=mine, minlength=len(column)).astype(np.int64)
        return sums, own, letters


def training_sample(docs: DataFrame, eligible: Column, seed: int = 3) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, stretches and their labels, from about ``FIT_DOCS`` documents of each language.

    Documents are chosen by a hash among all that are ``eligible`` and have text and language, so
    the choice is the same on every run; the stretches lie anywhere in the whole text. Twice the expected
    number is the most that is taken.
    """
    labelled = docs.where(eligible & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return [], np.empty((0, STRETCH), np.int16), np.empty(0, np.int64)
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, FIT_DOCS / n)]), F.col("lang"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (g for b in batches for g in groups(b)):
            data, bounds = text_bytes(batch.column("text"))
            data = lowered(data)
            languages, found, draws = [], [], []
            own_draw = batch.column("draw").to_pylist()
            for i, language in enumerate(batch.column("lang").to_pylist()):
                own = data[bounds[i] : bounds[i + 1]]
                rng = np.random.default_rng([seed, len(own)])
                for start in rng.integers(0, max(1, len(own) - STRETCH + 1), FIT_STRETCHES):
                    piece = own[start : start + STRETCH]
                    if _LETTER[piece].sum() >= 8:
                        languages.append(language)
                        found.append(piece.tobytes())
                        draws.append(own_draw[i])
            arrays = [pa.array(languages, pa.string()), pa.array(found, pa.binary()), pa.array(draws, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "stretch", "draw"])

    drawn = labelled.withColumn("draw", draw / share).where("draw < 1").select("lang", "text", "draw")
    most = 2 * len(counts) * FIT_DOCS * FIT_STRETCHES
    picked = mapped(drawn, cut, "lang string, stretch binary, draw double").orderBy("draw", "stretch").limit(most).collect()
    picked = sorted((r["lang"], bytes(r["stretch"])) for r in picked)
    languages = sorted({k for k, _ in picked})
    rows = np.full((len(picked), STRETCH), _PAD, np.int16)
    for i, (_, piece) in enumerate(picked):
        rows[i, : len(piece)] = np.frombuffer(piece, np.uint8)
    label = np.array([languages.index(k) for k, _ in picked], np.int64)
    return languages, rows, label


def fit(docs: DataFrame, eligible: Column) -> Network | None:
    """A network trained on ``text`` and ``lang`` of the eligible documents; None without any.

    Languages are drawn alike, however many documents each has.
    """
    languages, rows, label = training_sample(docs, eligible)
    if not languages:
        return None
    network = Network.new(languages)
    held = np.bincount(label)
    even = np.concatenate([np.resize(np.flatnonzero(label == k), held.max()) for k in range(len(languages))])
    network.train(rows[even], label[even])
    network._moments = []
    return network


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def identify(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """Every row of ``docs`` as ``row``, with ``lang_pred``, ``score``, ``n_letters`` and ``n_agree``.

    ``score`` is the mean probability of the predicted language over the bytes of letters, and ``n_agree``
    says at how many of these the position's own label is the document's. Texts that are null or
    have no letter get ``und`` and a score of 0, and so do all where there is no network. Ties go to
    the language that comes first in the alphabet. Rows are judged one by one; no other column is read.
    """
    rows = docs.select(F.struct("*").alias("row"))
    place = docs.columns.index(text)

    def with_text(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = batch.column(0).field(place).cast(pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), own], names=["row", "text"])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (g for b in batches for g in groups(with_text(b))):
            texts = batch.column("text")
            known = np.array([has_letter(t.as_py()) for t in texts], bool)
            if network is None:
                known[:] = False
                sums, own, letters = np.zeros((len(texts), 1)), np.zeros((len(texts), 1), int), np.zeros(len(texts), int)
            else:
                sums, own, letters = network.pooled(texts)
            best = sums.argmax(axis=1)
            at = np.arange(len(texts))
            score = np.where(known, sums[at, best] / np.maximum(letters, 1), 0.0).clip(0, 1)
            names = [network.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(names, pa.string()), pa.array(score), pa.array(letters), pa.array(own[at, best])],
                names=["row", "lang_pred", "score", "n_letters", "n_agree"],
            )

    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, n_letters bigint, n_agree bigint"
    return mapped(rows, predict, schema)


def held_out(key: str = "doc_id") -> Column:
    """The third of the documents that is never learned from; a null id is not in it, nor learned from."""
    return F.crc32(F.col(key).cast("string")) % 3 == 1


@QUERIES.add("op3_language_id")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    network = fit(docs, ~held_out())
    found = identify(docs.select("doc_id", "text"), network)
    apart = F.coalesce(held_out("row.doc_id"), F.lit(False)).alias("held_out")
    return found.select(F.col("row.doc_id").alias("doc_id"), apart, "lang_pred", "score", "n_letters", "n_agree")
