"""Exact Jaccard join of texts' word shingles by partitioned segments.

Two sets that reach the threshold differ in at most H members, H growing with their sizes.
Hashing the universe of shingles into m segments, m > H, leaves at least one segment in which they do not
differ. More generally each segment i of a probing set may be allocated 0 (not asked), 1 (asked for
an equal subset) or 2 (asked for a subset that differs by one member, through the subsets with one
member deleted); as long as the allocations sum up to more than H, no linked pair is missed. Costs
decide: small subsets, above all empty ones, are what unrelated sets share, so they get 0 first, and what is
missing from the sum then is made up by 2 on segments whose deletion neighbourhoods are indexed. A share of
all sets has the same segment empty, so one set that asks for an empty one meets a share of the corpus; so many
neighbourhoods are indexed that this is rare.

Sets come in bands of sizes; a set is indexed in its own band, and probes there and, where its size
allows, in the band below. Equal sets are one class from the start. Classes that share a
signature are candidates if one of them asks for it; they are brought together by the class that shares most
with the others, and those that ask are compared with all, the rest not with each other.
Outlines, which hold how many members fall in each of a few cells, rule out most of them, since two sets
differ in no fewer members than their outlines do; the rest is verified exactly, block by block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import QUERIES, groups, mapped, on_workers, table
from graphloom.llm.components import components
from graphloom.llm.cuckoo import CuckooFilter
from graphloom.llm.words import UNSPACED, Words, mixed
from graphloom.sources.scratch import written

#: Words of a shingle; shared members in percent of the union from which on sets are linked.
WORDS, PERCENT = 4, 85
#: The least number of first segments of a band whose one-deletion neighbourhoods are indexed.
DELETION_SEGMENTS = 2
#: As many more than the mean of empty segments are indexed this way as make this many standard deviations.
DELETION_SPREAD = 4
#: Members for each cell of an outline, about: so few that unlike sets of any size show.
CELL_MEMBERS = 8
#: Classes of a block when candidates are compared.
BLOCK = 1024
#: The same for their outlines, which are small: larger blocks are copied to fewer others.
OUTLINE_BLOCK = 4096
#: Candidate classes up to which a filter of them is sent to all tasks, at up to 12 bytes each.
MOST_FILTERED = 10_000_000

_INDEX, _PROBE = 1, 2
_SALT = np.uint64(0x9E3779B97F4A7C15)


class Bands:
    """Bands of set sizes and how many members two linked sets may differ in."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        tops = [1]
        while tops[-1] < 1 << 40:
            # So wide that linked sets never lie more than one band apart.
            tops.append(max(tops[-1] + 1, -(-tops[-1] * max(150, -(-10_000 // percent)) // 100)))
        self.tops = np.array(tops, np.int64)
        largest = self.tops * 100 // percent
        self.segments = self.differ(self.tops, largest) + 1
        # The largest sets that ask in a band ask for all of its segments. Of these some are empty, and some
        # hold a single member, which allows no deletion.
        held = largest / self.segments
        empty = self.segments * np.exp(-held)
        wanted = 1 + (empty + DELETION_SPREAD * np.sqrt(empty)) / (1 - np.exp(-held) * (1 + held))
        #: The first segments of each band, whose one-deletion neighbourhoods are indexed.
        self.deletions = np.minimum(np.maximum(np.ceil(wanted).astype(np.int64), DELETION_SEGMENTS), self.segments)

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Most members that are in only one of two linked sets of these sizes."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.tops, sizes)


class Shingles:
    """The distinct shingles of each text of a column, as 64-bit hashes: ``members`` of set i lie from
    ``bounds[i]`` to ``bounds[i + 1]``, in ascending order."""

    def __init__(self, column: pa.Array, size: int = WORDS):
        words = Words(column, UNSPACED)
        n_words = np.diff(words.first)
        firsts, hashes = words.windows(size)
        text = words.text[firsts]
        found = [(text, hashes)]
        for short in np.intersect1d(n_words, np.arange(1, size)).tolist():
            # A text with fewer words is one shingle as a whole.
            firsts, hashes = words.windows(short)
            text = words.text[firsts]
            own = n_words[text] == short
            found.append((text[own], hashes[own]))
        text, members = (np.concatenate(x) for x in zip(*found))
        if len(found) > 1:
            order = np.argsort(text, kind="stable")
            text, members = text[order], members[order]
        ends = np.searchsorted(text, np.arange(len(column)), side="right").tolist()
        for start, end in zip([0, *ends], ends):
            members[start:end].sort()
        new = np.ones(len(members), bool)
        new[1:] = (members[1:] != members[:-1]) | (text[1:] != text[:-1])
        text, self.members = text[new], members[new]
        self.sizes = np.bincount(text, minlength=len(column)).astype(np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])

    def of(self, i: int) -> np.ndarray:
        return self.members[self.bounds[i] : self.bounds[i + 1]]

    def outlines(self) -> list[bytes]:
        """For each set how many of its members fall in each cell, as far as a byte counts. The number
        of cells is a power of two, so an outline with more cells folds into one with fewer."""
        cells = 1 << np.ceil(np.log2(np.maximum(self.sizes / CELL_MEMBERS, 1))).astype(np.int64)
        base = np.cumsum(cells) - cells
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        cell = base[owner] + (mixed(self.members + _SALT) & (cells[owner] - 1).astype(np.uint64)).astype(np.int64)
        data = np.minimum(np.bincount(cell, minlength=int(cells.sum())), 255).astype(np.uint8).tobytes()
        return [data[a : a + n] for a, n in zip(base.tolist(), cells.tolist())]

    def keys(self) -> list[bytes | None]:
        """128 bits that stand for the whole set; None for an empty one."""
        return [
            hashlib.md5(self.of(i).tobytes(), usedforsecurity=False).digest() if n else None for i, n in enumerate(self.sizes)
        ]


def _ragged(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists of these sizes one after the other: the list of each place, and the place in it."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]


def _signature(subset: np.ndarray, band: np.ndarray, segment: np.ndarray, deleted: bool) -> np.ndarray:
    place = (band.astype(np.uint64) << np.uint64(40)) + (segment.astype(np.uint64) << np.uint64(1)) + np.uint64(deleted)
    return mixed(subset ^ mixed(place + _SALT))


def signatures(shingles: Shingles, chosen: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of the ``chosen`` sets: the set, the signature, and whether it indexes or probes."""
    sizes = shingles.sizes[chosen]
    own = bands.of(sizes)
    below = np.flatnonzero((own > 0) & (sizes * bands.percent <= bands.tops[own - 1] * 100))
    # Every set in its own band, then those that are also asked for in the band below.
    owner = np.concatenate([np.arange(len(chosen)), below])
    band = np.concatenate([own, own[below] - 1])
    guest = np.arange(len(owner)) >= len(chosen)
    size = sizes[owner]
    other = np.where(guest, bands.tops[band], size)
    need = bands.differ(size, other) + 1  # what allocations have to sum up to
    m = bands.segments[band]
    base = np.cumsum(m) - m

    entry, at = _ragged(size)
    token = shingles.members[shingles.bounds[chosen[owner[entry]]] + at]
    segment = ((token >> np.uint64(32)) * m[entry].astype(np.uint64)) >> np.uint64(32)
    cell = base[entry] + segment.astype(np.int64)
    total = int(m.sum())
    spread = mixed(token ^ _SALT)
    subset = np.zeros(total, np.uint64)
    np.add.at(subset, cell, spread)
    held = np.bincount(cell, minlength=total)

    of, number = _ragged(m)
    # The costliest subsets, which are the smallest, get 0 as far as the sum allows.
    order = np.lexsort((-held, of))
    rank = np.empty(total, np.int64)
    rank[order] = number  # within a set the numbers run as the ranks do
    one = rank < need[of]
    # Empty ones that would still be asked for are made up by 2 on indexed neighbourhoods.
    empty = one & (held == 0)
    wanting = np.bincount(of[empty], minlength=len(m))
    # A subset of one member less its member is an empty one again.
    near_by = (number < bands.deletions[band][of]) & (held > 1)
    able = one & near_by & (wanting[of] > 0)
    nth = np.cumsum(able) - 1
    nth -= np.concatenate([[0], np.cumsum(np.bincount(of[able], minlength=len(m)))[:-1]])[of]
    two = able & (nth < wanting[of])
    made_up = np.bincount(of[two], minlength=len(m))
    spared = np.flatnonzero(empty)
    nth = np.arange(len(spared)) - np.searchsorted(of[spared], of[spared])
    one[spared[nth < made_up[of[spared]]]] = False

    found = []
    flag = np.where(guest[of], 0, _INDEX) | np.where(one, _PROBE, 0)
    kept = flag > 0
    plain = _signature(subset, band[of], number, False)
    found.append((owner[of[kept]], plain[kept], flag[kept]))
    # Deletions: indexed where a set could be asked for this way, probing where 2 is allocated.
    indexed = ~guest[of] & near_by
    near = _signature(subset, band[of], number, True)
    found.append((owner[of[two]], near[two], np.full(int(two.sum()), _PROBE)))
    for cells, flag_value, deleted in ((indexed, _INDEX, True), (two, _PROBE, False)):
        at = np.flatnonzero(cells[cell])
        less = subset[cell[at]] - spread[at]
        place = of[cell[at]]
        found.append((owner[place], _signature(less, band[place], number[cell[at]], deleted), np.full(len(at), flag_value)))
    owners, values, flags = (np.concatenate(x) for x in zip(*found))
    return chosen[owners], values, flags


def classes(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """``doc_id``, ``n_shingles``, and the ``key``, ``handle`` and ``outline`` of the set (null if it is empty) of every row."""

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (g for b in batches for g in groups(b)):
            shingles = Shingles(batch.column("text"), size)
            keys = shingles.keys()
            outlines = [o if k else None for o, k in zip(shingles.outlines(), keys)]
            handles = [int.from_bytes(k[:8], "little", signed=True) if k else None for k in keys]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(shingles.sizes), pa.array(keys, pa.binary()),
                    pa.array(handles, pa.int64()), pa.array(outlines, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "key", "handle", "outline"],
            )

    schema = "doc_id bigint, n_shingles bigint, key binary, handle bigint, outline binary"
    return mapped(docs.select("doc_id", "text"), classify, schema)


def _handles(keys: list[bytes]) -> np.ndarray:
    """64 bits of each key, by which candidates are found; what is verified goes by whole keys."""
    return np.frombuffer(b"".join(keys), np.int64)[::2]


def signature_rows(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``signature``, ``handle`` of the class, and ``flag``, for each class of a batch once."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            seen: set[bytes] = set()
            for part in groups(batch):
                shingles = Shingles(part.column("text"), size)
                keys = shingles.keys()
                chosen = []
                for i, key in enumerate(keys):
                    if key is not None and key not in seen:
                        seen.add(key)
                        chosen.append(i)
                if not chosen:
                    continue
                owner, signature, flag = signatures(shingles, np.array(chosen), bands)
                handle = np.zeros(len(keys), np.int64)
                handle[chosen] = _handles([keys[i] for i in chosen])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signature.view(np.int64)), pa.array(handle[owner]), pa.array(flag.astype(np.int8))],
                    names=["signature", "handle", "flag"],
                )

    return mapped(docs.select("text"), sign, "signature bigint, handle bigint, flag tinyint")


def shared_signatures(rows: DataFrame) -> DataFrame:
    """The rows of signatures by which some class probes another, once for each class, and whether it ``probes``.

    Rows come by signature; a task looks at one batch after the other and hands the last,
    perhaps unfinished, signature on to the next.
    """

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int8)]

        def shared(signature: np.ndarray, handle: np.ndarray, flag: np.ndarray) -> pa.RecordBatch:
            # Most signatures have one row, which is shared by none.
            twin = np.zeros(len(signature) + 1, bool)
            twin[1:-1] = signature[1:] == signature[:-1]
            twin = twin[1:] | twin[:-1]
            signature, handle, flag = signature[twin], handle[twin], flag[twin]
            if len(signature):
                order = np.lexsort((handle, signature))
                signature, handle, flag = signature[order], handle[order], flag[order]
                first = np.ones(len(signature), bool)
                first[1:] = (signature[1:] != signature[:-1]) | (handle[1:] != handle[:-1])
                flag = np.bitwise_or.reduceat(flag, np.flatnonzero(first))
                signature, handle = signature[first], handle[first]
                start = np.ones(len(signature), bool)
                start[1:] = signature[1:] != signature[:-1]
                bucket = np.cumsum(start) - 1
                size = np.bincount(bucket)
                useful = (size > 1) & (np.bitwise_or.reduceat(flag, np.flatnonzero(start)) == (_INDEX | _PROBE))
                kept = useful[bucket]
                signature, handle, flag = signature[kept], handle[kept], flag[kept]
                size = size[bucket[kept]]
            else:
                size = signature
            return pa.RecordBatch.from_arrays(
                [pa.array(signature), pa.array(handle), pa.array(size.astype(np.int64)), pa.array((flag & _PROBE) > 0)],
                names=["signature", "handle", "size", "probes"],
            )

        for batch in batches:
            columns = [np.concatenate([r, np.asarray(batch.column(i))]) for i, r in enumerate(rest)]
            end = int(np.searchsorted(columns[0], columns[0][-1])) if len(columns[0]) else 0
            rest = [c[end:] for c in columns]
            yield shared(*(c[:end] for c in columns))
        yield shared(*rest)

    dealt = rows.repartition("signature").sortWithinPartitions("signature")
    return mapped(dealt, share, "signature bigint, handle bigint, size bigint, probes boolean")


def candidate_groups(shared: DataFrame) -> DataFrame:
    """``leader`` and ``handle``: the classes of each signature under the one that shares most; and ``probes``.

    Classes that are candidates of each other share a signature, and so lie in one group at least, where
    one of them probes.
    """
    known = shared.groupBy("handle").agg(F.sum("size").alias("weight"))
    weighed = shared.join(known, "handle")
    leaders = weighed.groupBy("signature").agg(F.max(F.struct("weight", "handle")).alias("top"))
    led = leaders.select("signature", F.col("top.handle").alias("leader"))
    return shared.select("signature", "handle", "probes").join(led, "signature").groupBy("leader", "handle").agg(
        F.bool_or("probes").alias("probes")
    )


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``handle``, ``key`` and ``members`` of the classes with a ``wanted`` handle."""
    n = wanted.count()
    shared = None
    if n <= MOST_FILTERED:
        handles = np.array([r[0] for r in wanted.toLocalIterator()], np.int64) if n else np.empty(0, np.int64)
        shared = docs.sparkSession.sparkContext.broadcast(CuckooFilter.of(_filter_keys(handles)))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[bytes] = set()
            for part in groups(batch):
                shingles = Shingles(part.column("text"), size)
                keys = shingles.keys()
                own = [i for i, k in enumerate(keys) if k is not None]
                handle = _handles([keys[i] for i in own])
                likely = shared.value.found(_filter_keys(handle)) if shared else np.ones(len(own), bool)
                chosen = []
                for i, good in zip(own, likely):
                    if good and keys[i] not in seen:
                        seen.add(keys[i])
                        chosen.append(i)
                picked = [keys[i] for i in chosen]
                members = [shingles.of(i).tobytes() for i in chosen]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_handles(picked)), pa.array(picked, pa.binary()), pa.array(members, pa.binary())],
                    names=["handle", "key", "members"],
                )

    found = mapped(docs.select("text"), collect, "handle bigint, key binary, members binary")
    return found.join(wanted, "handle", "left_semi").groupBy("handle", "key").agg(F.any_value("members").alias("members"))


def _filter_keys(handles: np.ndarray) -> np.ndarray:
    spread = handles.view(np.uint64)
    return np.stack([spread, mixed(spread + _SALT)], axis=1)


class _Forest:
    """Union-find over the classes of a group, for one link less than a component has classes."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def link_block(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect what is linked in one block, or between two blocks.

    Numbers count through both blocks. Every pair is compared, through lists of the
    sets that hold a member; links within what is connected already are left out.
    """
    sets = left + (right or [])
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    _, member = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    against = owner >= len(left) if right is not None else np.ones(len(owner), bool)
    order = np.argsort(member[against], kind="stable")
    postings = owner[against][order]
    counts = np.bincount(member[against], minlength=int(member.max()) + 1)
    ends = np.cumsum(counts)
    starts = ends - counts
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    forest, links = _Forest(len(sets)), []
    for i in range(len(left)):
        own = member[bounds[i] : bounds[i + 1]]
        _, at = _ragged(counts[own])
        places = np.repeat(starts[own], counts[own]) + at
        common = np.bincount(postings[places], minlength=len(sets))
        linked = (100 + percent) * common >= percent * (sizes[i] + sizes)
        linked[: i + 1 if right is None else len(left)] = False
        for j in np.flatnonzero(linked):
            if forest.join(i, int(j)):
                links.append((i, int(j)))
    return links


def in_blocks(grouped: DataFrame, classes: DataFrame, block: int) -> DataFrame:
    """The members of each group with the columns of their classes, by ``leader`` and a pair of blocks ``x`` and ``y``.

    A group of many classes is cut into blocks by hash (``own``), and each pair of blocks is a group of
    its own, so no task holds more than two blocks at once. The classes that probe have the first blocks,
    and the others meet these blocks only.
    """
    size = grouped.groupBy("leader").agg(F.count("*").alias("n"), F.count_if("probes").alias("n_probing"))
    many = F.col("n") > block
    cut = lambda n: F.when(many, F.ceil(n / block)).cast("int")
    size = size.select(
        "leader",
        F.coalesce(cut(F.col("n_probing")), F.lit(1)).alias("probing"),
        F.coalesce(cut(F.col("n") - F.col("n_probing")), F.lit(0)).alias("asked"),
    )
    in_first = F.col("probes") | (F.col("asked") == 0)
    hashed = F.xxhash64("handle")
    number = F.when(in_first, F.pmod(hashed, "probing")).otherwise(F.col("probing") + F.pmod(hashed, F.greatest("asked", F.lit(1))))
    others = F.col("probing") + F.when(in_first, F.col("asked")).otherwise(0)
    placed = grouped.join(size.where("probing > 0"), "leader").withColumns({"own": number.cast("int"), "others": others})
    # With itself and with every other block; the smaller number comes first.
    with_each = F.transform(
        F.sequence(F.lit(0), F.col("others") - 1),
        lambda i: F.struct(F.least("own", i).alias("x"), F.greatest("own", i).alias("y")),
    )
    pairs = placed.select("leader", "handle", "probes", "own", F.explode(with_each).alias("pair"))
    return pairs.join(classes, "handle").select("leader", "pair.x", "pair.y", "own", "probes", *classes.columns)


def possible(grouped: DataFrame, outlines: DataFrame, percent: int = PERCENT, block: int = OUTLINE_BLOCK) -> DataFrame:
    """The members that may be linked within their group, by sizes and outlines, with one that probes or, if they probe
    themselves, with any."""
    on_workers(grouped.sparkSession)

    def narrow(group: tuple, part: pa.Table) -> pa.Table:
        own, size = np.asarray(part.column("own")), np.asarray(part.column("n_shingles"))
        outlines = [np.frombuffer(o, np.uint8).astype(np.int16) for o in part.column("outline").to_pylist()]
        cells = np.fromiter(map(len, outlines), np.int64, len(outlines))
        leader, x, y = (g.as_py() for g in group)
        probes = np.asarray(part.column("probes").combine_chunks())
        first, second = np.flatnonzero((own == x) & probes), np.flatnonzero(own == y)
        bands, kept = Bands(percent), np.zeros(len(own), bool)
        for many in np.unique(cells[second]).tolist():
            against = second[cells[second] == many]
            stack = np.stack([outlines[j] for j in against])
            folded = {many: stack}
            for i in first:
                # Linked sets have sizes, and so numbers of cells, that are close to each other.
                likely = (size[against] * 100 >= size[i] * percent) & (size[i] * 100 >= size[against] * percent)
                if not likely.any():
                    continue
                fewer = min(many, int(cells[i]))
                if fewer not in folded:
                    folded[fewer] = stack.reshape(len(stack), -1, fewer).sum(axis=1, dtype=np.int16)
                outline = outlines[i].reshape(-1, fewer).sum(axis=0, dtype=np.int16)
                chosen = np.flatnonzero(likely)
                apart = np.abs(folded[fewer][chosen] - outline).sum(axis=1, dtype=np.int64)
                near = against[chosen[apart <= bands.differ(size[i], size[against[chosen]])]]
                near = near[near != i]
                kept[near] = True
                kept[i] |= len(near) > 0
        handles = np.asarray(part.column("handle"))[kept]
        leaders = np.full(len(handles), leader, np.int64)
        return pa.table({"leader": pa.array(leaders), "handle": pa.array(handles), "probes": pa.array(probes[kept])})

    rows = in_blocks(grouped, outlines, block)
    return rows.groupBy("leader", "x", "y").applyInArrow(narrow, "leader bigint, handle bigint, probes boolean").distinct()


def verified_links(grouped: DataFrame, sets: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """``a`` and ``b``, keys of linked classes, enough to connect all that are linked within a group."""
    on_workers(grouped.sparkSession)

    def link(group: tuple, part: pa.Table) -> pa.Table:
        part = part.sort_by("key")
        own, key = np.asarray(part.column("own")), part.column("key").to_pylist()
        members = [np.frombuffer(m, np.uint64) for m in part.column("members").to_pylist()]
        x, y = (g.as_py() for g in group[1:])
        first, second = np.flatnonzero(own == x), np.flatnonzero(own == y)
        names = [key[i] for i in first]
        right = None
        if x != y:
            names += [key[i] for i in second]
            right = [members[i] for i in second]
        links = link_block([members[i] for i in first], right, percent) if len(names) > 1 and len(first) else []
        ends = zip(("a", "b"), ([names[pair[k]] for pair in links] for k in (0, 1)))
        return pa.table({name: pa.array(keys, pa.binary()) for name, keys in ends})

    rows = in_blocks(grouped, sets, block)
    return rows.groupBy("leader", "x", "y").applyInArrow(link, "a binary, b binary")


def near_duplicates(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Every row's ``doc_id``, ``n_shingles`` and ``component_id``.

    The set of a text is its distinct shingles of ``size`` words, where words lie between ASCII white
    space and A-Z count as a-z; a text with fewer words is one shingle, and one without words has an
    empty set that is linked with nothing. Sets are linked when they share at least
    ``percent`` of their union. ``component_id`` is the smallest ``doc_id`` that is reached by
    links, the row's own included. Repeated rows are equal sets and so linked. Rows with a null id
    take part, but name a component only where it has no other id.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    rows = written(classes(docs, size), "shingle-classes")
    shared = written(shared_signatures(signature_rows(docs, size, percent)), "shared-signatures")
    outlines = rows.where(F.col("key").isNotNull()).groupBy("handle", "key").agg(
        F.any_value("n_shingles").alias("n_shingles"), F.any_value("outline").alias("outline")
    )
    grouped = written(possible(candidate_groups(shared), outlines, percent), "candidate-groups")
    sets = written(_sets(docs, grouped.select("handle").distinct(), size), "candidate-sets")
    roots = components(verified_links(grouped, sets, percent))
    first = rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("first"))
    rooted = first.join(roots.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "first", F.coalesce("root", "key").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_class = rooted.join(named, "root").select("key", "component_id")
    found = rows.join(by_class, "key", "left")
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", own.alias("component_id"))


_ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
reached AS (
  SELECT doc_id, doc_id AS other FROM words
  UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other)
SELECT doc_id, coalesce(n, 0)::bigint AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)"""


@QUERIES.add("op5_jaccard_join", _ORACLE)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))
