"""Addresses in parts, and lookup of addresses that are not written alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.ids import normal_address

# A house number: digits and a letter, or several of these.
_NUMBER = r"[0-9]+\p{L}?(?:\s*[;/-]\s*[0-9]+\p{L}?)*"
_FIRST = rf"^\s*({_NUMBER})\s+(\S.*)$"
_LAST = rf"^(.*\S)\s+({_NUMBER})\s*$"
#: Entries that share a piece, beyond which they are looked up by what is left of them without some characters.
COMMON = 16


def parse_address(c: Column) -> Column:
    """``road``, ``house_number``, ``type`` and ``place`` of an address, each null where it has none.

    The road and the number are what stands before the first comma, the number first or last; the place is what
    follows. The type is ``house`` with a number and ``road`` without. Roads and places are normal texts.
    """
    line = F.split_part(c, F.lit(","), F.lit(1))
    first, last = F.regexp_extract(line, _FIRST, 1) != "", F.regexp_extract(line, _LAST, 2) != ""
    number = F.when(first, F.regexp_extract(line, _FIRST, 1)).when(last, F.regexp_extract(line, _LAST, 2))
    rest = F.when(first, F.regexp_extract(line, _FIRST, 2)).when(last, F.regexp_extract(line, _LAST, 1)).otherwise(line)
    road = F.nullif(normal_address(rest), F.lit(""))
    place = F.nullif(normal_address(F.substring(c, F.length(line) + 2, F.length(c))), F.lit(""))
    kind = F.when(number.isNotNull(), "house").when(road.isNotNull(), "road")
    return F.struct(
        road.alias("road"), F.lower(F.regexp_replace(number, r"\s", "")).alias("house_number"), kind.alias("type"), place.alias("place")
    )


def _cuts(length: Column, number: int, pieces: int) -> tuple[Column, Column]:
    """Where a piece of a text of some length starts, from 1, and how long it is; the pieces are of about one length."""
    start = F.floor(length * number / pieces)
    return (start + 1).cast("int"), (F.floor(length * (number + 1) / pieces) - start).cast("int")


def _shortened(text: Column, most: int) -> list[Column]:
    """The distinct texts that are left when so many characters are taken out, for each number up to ``most``."""

    def without_one(one: Column) -> Column:
        # Taking out any character of a run leaves the same text, so the last one stands for all.
        places = F.filter(F.sequence(F.lit(1), F.length(one)), lambda i: F.substring(one, i, F.lit(1)) != F.substring(one, i + 1, F.lit(1)))
        left = F.transform(places, lambda i: F.concat(F.substring(one, F.lit(1), i - 1), F.substring(one, i + 1, F.length(one))))
        return F.when(F.length(one) > 0, left).otherwise(F.array(F.lit("")))

    made = [F.array(text)]
    for _ in range(most):
        made.append(F.array_distinct(F.flatten(F.transform(made[-1], without_one))))
    return made


def _met_by_pieces(texts: DataFrame, entries: DataFrame, most: int) -> DataFrame:
    """``house_number``, ``text`` and ``entry`` where a piece of the entry is in the text, moved by as many places at most."""
    pieces = most + 1
    at_sizes = texts.join(entries.select("house_number", "size").distinct(), "house_number").where(F.abs(F.col("size") - F.length("text")) <= most)
    asked = []
    for i in range(pieces):
        start, length = _cuts(F.col("size"), i, pieces)
        for moved in range(-most, most + 1):
            at = start + moved
            # A piece without characters is in every text; it stands at its own place only.
            there = (at >= 1) & (at + length - 1 <= F.length("text")) & ((length > 0) | F.lit(moved == 0))
            asked.append(F.when(there, F.struct(F.lit(i).alias("piece"), F.substring("text", at, length).alias("part"))))
    probes = at_sizes.select("house_number", "text", "size", F.explode(F.array_compact(F.array_distinct(F.array(*asked)))).alias("c"))
    return probes.select("house_number", "text", "size", "c.*").join(_pieces(entries, pieces), ["house_number", "size", "piece", "part"])


def _pieces(entries: DataFrame, pieces: int) -> DataFrame:
    cut = [F.struct(F.lit(i).alias("piece"), F.substring("entry", *_cuts(F.col("size"), i, pieces)).alias("part")) for i in range(pieces)]
    return entries.select("house_number", "entry", "size", F.explode(F.array(*cut)).alias("c")).select("house_number", "entry", "size", "c.*")


def _met_by_shortening(texts: DataFrame, entries: DataFrame, most: int) -> DataFrame:
    """``house_number``, ``text`` and ``entry`` that are the same when some characters are taken out of either.

    Of two texts that are near, ``most`` characters of the longer and as many fewer of the shorter as it is shorter can be
    taken out so that the same is left. Texts are shortened only to lengths that entries of their house number need.
    """
    lengths = texts.select("house_number", F.length("text").alias("length")).distinct()
    pairs = entries.select("house_number", "size").distinct().join(lengths, "house_number").where(F.abs(F.col("size") - F.col("length")) <= most)
    pairs = pairs.withColumn("rest", F.greatest(F.lit(0), F.greatest("size", "length") - most))

    def keys(rows: DataFrame, name: str, own: str) -> DataFrame:
        wanted = pairs.select("house_number", own, *([] if own == "size" else ["size"]), "rest").distinct()
        taken, left = F.col(own) - F.col("rest"), F.lit(None).cast("array<string>")
        for number, shorter in reversed(list(enumerate(_shortened(F.col(name), most)))):
            left = F.when(taken == number, shorter).otherwise(left)
        dealt = rows.withColumn(own, F.length(name)).join(wanted, ["house_number", own])
        # A hash of what is left: keys that clash give a pair more to verify and lose none.
        return dealt.select("house_number", name, "size", "rest", F.explode(left).alias("left")).select(
            "house_number", name, F.xxhash64("house_number", "size", "rest", "left").alias("key"))

    return keys(texts, "text", "length").join(keys(entries.select("house_number", "entry"), "entry", "size"), ["house_number", "key"])


def near_pairs(left: DataFrame, right: DataFrame, most: int = 2) -> DataFrame:
    """``house_number``, ``text``, ``entry`` and ``distance`` of texts of either side that differ by ``most`` edits or less.

    Both sides have ``house_number``, which must be equal, and ``text``. An entry is cut into one piece more than there may be
    edits, so one piece at least is whole in each text near it, moved by as many places at most. Pieces are joined by
    equality. Entries with a piece that more than ``COMMON`` entries share are met by what is left of them without some
    characters instead, of which there are about size to the power of ``most``, and which few texts that are not near share. What
    meets is verified: no near pair is missed, and neither way makes pairs of all texts that begin alike.
    """
    entries = right.select("house_number", F.col("text").alias("entry")).distinct().withColumn("size", F.length("entry"))
    texts = left.select("house_number", "text").distinct()
    place = ["house_number", "size", "piece", "part"]
    cut = _pieces(entries, most + 1)
    common = cut.groupBy(*place).agg(F.count("*").alias("n")).where(F.col("n") > COMMON)
    hard = cut.join(common, place, "left_semi").select("house_number", "entry", "size").distinct()
    easy = entries.join(hard, ["house_number", "entry", "size"], "left_anti")
    columns = ["house_number", "text", "entry"]
    met = _met_by_pieces(texts, easy, most).select(*columns).unionByName(_met_by_shortening(texts, hard, most).select(*columns))
    near = met.withColumn("distance", F.levenshtein("text", "entry", most)).where(F.col("distance") >= 0)
    return near.distinct()


def look_up_near(
    rows: DataFrame, address: str, gazetteer: DataFrame, fields: Sequence[str], most: int = 2
) -> DataFrame:
    """Add fields of a gazetteer, and the ``distance``, to rows by an address that is nearly the same.

    House numbers, as :func:`parse_address` finds them, must be equal or missing on both sides; the other words of
    the normal addresses may differ by ``most`` edits. The nearest entry is taken, of several the first by its words
    and then by the fields. An address without words, and one without an entry near it, gives nulls.
    """
    def parts(c: Column) -> list[Column]:
        found = parse_address(c)
        return [F.coalesce(found["house_number"], F.lit("")).alias("house_number"), F.concat_ws(" ", found["road"], found["place"]).alias("text")]

    known = gazetteer.select(*parts(F.col("address")), F.struct(*fields).alias("entry_fields")).where("text <> ''")
    best_fields = known.groupBy("house_number", F.col("text").alias("entry")).agg(F.min("entry_fields").alias("f"))
    asked = rows.select("*", F.struct(*parts(F.col(address))).alias("__parts"))
    pairs = near_pairs(asked.select("__parts.*").where("text <> ''"), known, most)
    best = pairs.groupBy("house_number", "text").agg(F.min(F.struct("distance", "entry")).alias("b"))
    found = best.select("house_number", "text", "b.*").join(best_fields, ["house_number", "entry"])
    side = found.select(F.struct("house_number", "text").alias("__parts"), F.col("f").alias("__f"), F.col("distance").alias("__distance"))
    joined = asked.join(side, "__parts", "left")
    return joined.select(*rows.columns, *[F.col(f"__f.{f}").alias(f) for f in fields], F.col("__distance").alias("distance"))
