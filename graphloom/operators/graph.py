"""Fan-out of source rows into property values, edges and rejects.

One select computes, per definition, its property values, its entity id and whether
it is created; one explode turns them into rows. There is one scan and no shuffle.
Columns named in ``keep`` are carried from the source row into the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from copy import copy
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.functions.steps import Row, run_chain
from graphloom.functions.text import base64_text, is_blank, not_blank
from graphloom.functions.types import normal_text
from graphloom.plans.catalog import Catalog
from graphloom.plans.mapping import BINARIES, NO_OP, TABLES, Association, Entity, Mapping, Property
from graphloom.sources.scratch import written_to

EDGE_COLUMNS = ("edge_set", "edge_id", "src_set", "src_id", "dst_set", "dst_id")


def destination_of(definition: Entity, prop: Property, catalog: Catalog) -> str:
    """Where the values of a property are written."""
    if definition.associate_only:
        return NO_OP
    if prop.destination is not None:
        return prop.destination
    return BINARIES if catalog.datatype(prop.type) == "Binary" else TABLES


@dataclass(frozen=True)
class _Slot:
    """A property of a definition and the column that holds its value."""

    definition: Entity
    prop: Property
    column: str
    many: bool
    datatype: str
    destination: str

    @property
    def value(self) -> Column:
        return F.col(self.column)

    @property
    def plain(self) -> bool:
        """One text at most, blank or not."""
        return not self.many and self.datatype != "Binary"

    @property
    def present(self) -> Column:
        return not_blank(self.value) if self.plain else self.value.isNotNull()


def _property_value(made: Column, kind: T.DataType, datatype: str, name: str) -> Column:
    """A value as text or bytes; a list without blanks and copies, and null when that leaves none."""
    if datatype == "Binary":
        if not isinstance(kind, (T.BinaryType, T.NullType)):
            raise ValueError(f"property {name} is binary but its value is {kind.simpleString()}")
        return made.cast("binary")
    if isinstance(kind, T.ArrayType):
        texts = F.filter(made.cast("array<string>"), not_blank)
        return F.when(F.size(texts) > 0, F.array_distinct(texts))
    return made if isinstance(kind, T.StringType) else made.cast("string")


def _any_present(slots: Sequence[_Slot]) -> Column:
    """Whether a property has a value; looks no further than the first that has."""
    found = F.lit(False)
    plain = [s.value for s in slots if s.plain]
    if plain:
        found = F.exists(F.array(*plain), not_blank)
    for slot in (s for s in slots if not s.plain):
        found = found | slot.present
    return found


def _encoded(c: Column) -> Column:
    return base64_text(c.cast("binary"))


def _default_id(keys: Sequence[tuple[str, bool] | None]) -> Column:
    """Id from the values of the ordered key properties; null when none of them has one.

    A key is a column and whether it holds a list, or None where the definition does
    not have the property. Values are base64 texts, so that the separators cannot occur
    in them.
    """
    parts, present = [], F.lit(False)
    for key in keys:
        if key is None:
            parts.append(F.lit(""))
            continue
        name, many = key
        c = F.col(name)
        part = F.array_join(F.transform(F.array_sort(c), _encoded), ",") if many else _encoded(c)
        parts.append(F.coalesce(part, F.lit("")))
        present = present | c.isNotNull()
    return F.when(present, F.concat_ws("|", *parts))


class FanOut:
    """Source rows with one column per property and, per definition ``i``, its id in ``i_id``.

    The id is null where the entity or association is not created. Each step is a
    select of its own, since the next one uses its columns more than once, and the code
    per property is kept small: mappings may have hundreds of them.
    """

    def __init__(self, df: DataFrame, mapping: Mapping, catalog: Catalog, keep: Sequence[str]):
        catalog.check(mapping)
        row = Row(df.columns)
        if mapping.condition is not None:
            df = df.where(mapping.condition(row))
        self.mapping = mapping
        self.number = {d.alias: i for i, d in enumerate(mapping.definitions)}
        kept = [row[name].alias(name) for name in keep]
        self.keep = [F.col("`" + name.replace("`", "``") + "`") for name in keep]
        raw = df.select(*kept, *[c.alias(n) for n, c in self._chains(row).items()])
        self.slots = self._slots(raw, catalog)
        with_keys, self.keys = self._with_keys(raw, catalog)
        entities = with_keys.select("*", *map(self._id, mapping.entities))
        self.df = entities.select("*", *map(self._id, mapping.associations))

    def written_to(self, path: str) -> FanOut:
        """The same, with the mapped rows as a table: whatever is taken from it maps no source row again."""
        made = copy(self)
        made.df = written_to(self.df, path)
        return made

    def _chains(self, row: Row) -> dict[str, Column]:
        made: dict[str, Column] = {}
        for i, d in enumerate(self.mapping.definitions):
            for j, p in enumerate(d.properties):
                made[f"__{i}_p{j}"] = run_chain(p.chain, row)
            if d.generator is not None:
                made[f"__{i}_given"] = run_chain(d.generator, row).cast("string")
            if d.condition is not None:
                made[f"__{i}_if"] = d.condition(row)
        return made

    def _slots(self, raw: DataFrame, catalog: Catalog) -> dict[str, list[_Slot]]:
        found: dict[str, list[_Slot]] = {}
        for i, d in enumerate(self.mapping.definitions):
            found[d.alias] = []
            for j, p in enumerate(d.properties):
                name, datatype = f"__{i}_p{j}", catalog.datatype(p.type)
                many = isinstance(raw.schema[name].dataType, T.ArrayType) and datatype != "Binary"
                slot = _Slot(d, p, name, many, datatype, destination_of(d, p, catalog))
                found[d.alias].append(slot)
        return found

    def _with_keys(self, raw: DataFrame, catalog: Catalog) -> tuple[DataFrame, dict[str, list]]:
        """Rows with clean property values, and with the values of key properties or null."""
        values = {
            slot.column: _property_value(slot.value, raw.schema[slot.column].dataType, slot.datatype, slot.prop.type)
            for d in self.mapping.definitions
            for slot in self.slots[d.alias]
        }
        given = [n for n in raw.columns[len(self.keep):] if n not in values]
        clean = raw.select(*self.keep, *given, *[c.alias(n) for n, c in values.items()])
        columns: list[Column] = []
        keys: dict[str, list] = {}
        for d in self.mapping.definitions:
            if d.generator is not None:
                continue
            by_name = {s.prop.type: s for s in self.slots[d.alias]}
            keys[d.alias] = []
            for name in catalog.set_type(d.entity_set).key:
                slot = by_name.get(name)
                if slot is None:
                    keys[d.alias].append(None)
                    continue
                columns.append(F.when(slot.present, slot.value).alias(f"{slot.column}_key"))
                keys[d.alias].append((f"{slot.column}_key", slot.many))
        return clean.select("*", *columns), keys

    def _id(self, d: Entity) -> Column:
        i = self.number[d.alias]
        if d.generator is not None:
            made = F.col(f"__{i}_given")
            created = not_blank(made) & _any_present(self.slots[d.alias])
        else:  # an id is there when a key property has a value
            made = _default_id(self.keys[d.alias])
            created = F.lit(True)
        if d.condition is not None:
            created = created & F.col(f"__{i}_if")
        if isinstance(d, Association):
            created = created & self.id(d.src).isNotNull() & self.id(d.dst).isNotNull()
        return F.when(created, made).alias(f"__{i}_id")

    def id(self, alias: str) -> Column:
        return F.col(f"__{self.number[alias]}_id")

    def has_no_id(self, d: Entity) -> Column:
        """Values are there but no id, for a definition that applies to the row."""
        i = self.number[d.alias]
        blank = is_blank(F.col(f"__{i}_given")) if d.generator is not None else F.lit(True)
        for key in self.keys.get(d.alias, ()):
            blank = blank & F.col(key[0]).isNull() if key is not None else blank
        found = blank & _any_present(self.slots[d.alias])
        if d.condition is not None:
            found = found & F.col(f"__{i}_if")
        if isinstance(d, Association):
            found = found & self.id(d.src).isNotNull() & self.id(d.dst).isNotNull()
        return found

    def explode(self, structs: Sequence[Column]) -> DataFrame:
        """Rows from structs; null structs are left out."""
        rows = self.df.select(*self.keep, F.explode(F.array(*structs)).alias("__v"))
        return rows.where(F.col("__v").isNotNull()).select(*self.keep, "__v.*")


def _is_wrong(datatype: str, value: Column) -> Column:
    return not_blank(value) & normal_text(value, datatype).isNull()


def entity_values(
    df: DataFrame,
    mapping: Mapping,
    catalog: Catalog,
    keep: Sequence[str] = (),
    fail_on_bad_value: bool = False,
) -> DataFrame:
    """Rows (entity_set, entity_id, property, destination, value, content), one per value.

    ``content`` holds binary values and ``value`` the normal text of all others. Values
    that are not of their property's datatype are left to :func:`rejects`, or end
    the query with ``fail_on_bad_value``.
    """
    return values_of(FanOut(df, mapping, catalog, keep), fail_on_bad_value)


def values_of(fan: FanOut, fail_on_bad_value: bool = False) -> DataFrame:
    """:func:`entity_values` of mapped rows."""
    mapping = fan.mapping
    slots = [s for d in mapping.definitions for s in fan.slots[d.alias]]
    # The exploded rows hold a slot number and a value. What is fixed for a slot is looked
    # up after the explode, and so are blanks and datatypes.
    ids = [fan.id(d.alias) for d in mapping.definitions]
    if all(s.plain for s in slots):
        values = F.posexplode(F.array(*[s.value for s in slots])).alias("__slot", "__text")
        rows = fan.df.select(*fan.keep, *ids, values)
        content = F.lit(None).cast("binary")
    else:
        rows = fan.df.select(*fan.keep, *ids, F.explode(_numbered(slots)).alias("__v"))
        rows = rows.select(*fan.keep, *ids, "__v.*")
        content = F.col("__content")

    def of_slot(values: list) -> Column:
        return F.get(F.array(*map(F.lit, values)), F.col("__slot"))

    definition = of_slot([fan.number[s.definition.alias] for s in slots])
    entity_id = F.lit(None).cast("string")
    for d in reversed(mapping.definitions):
        entity_id = F.when(F.col("__definition") == fan.number[d.alias], fan.id(d.alias)).otherwise(entity_id)
    rows = rows.withColumn("__definition", definition).select(
        *fan.keep, entity_id.alias("entity_id"), "__slot", "__text", content.alias("content")
    )
    rows = rows.where(F.col("entity_id").isNotNull() & (not_blank(F.col("__text")) | F.col("content").isNotNull()))
    text = F.col("__text")
    value = text
    for datatype in sorted({s.datatype for s in slots} - {"Binary", "String"}):
        normal = normal_text(text, datatype)
        if fail_on_bad_value:
            message = F.concat(of_slot([s.prop.type for s in slots]), F.lit(f": not a {datatype}: "), text)
            normal = F.when(normal.isNull(), F.raise_error(message)).otherwise(normal)
        value = F.when(of_slot([s.datatype == datatype for s in slots]), normal).otherwise(value)
    made = rows.select(
        *fan.keep,
        of_slot([s.definition.entity_set for s in slots]).alias("entity_set"),
        "entity_id",
        of_slot([s.prop.type for s in slots]).alias("property"),
        of_slot([s.destination for s in slots]).alias("destination"),
        value.alias("value"),
        "content",
    )
    return made.where(F.col("value").isNotNull() | F.col("content").isNotNull())


def _numbered(slots: Sequence[_Slot]) -> Column:
    """Array of (slot, text, content) of slots of any kind."""

    def struct(number: int, text: Column, content: Column) -> Column:
        return F.struct(F.lit(number).alias("__slot"), text.alias("__text"), content.alias("__content"))

    def of_list(number: int, text: Column) -> Column:
        return struct(number, text, F.lit(None).cast("binary"))

    single, lists = [], []
    for number, slot in enumerate(slots):
        if slot.many:
            lists.append(F.coalesce(F.transform(slot.value, partial(of_list, number)), F.array().cast(_NUMBERED)))
        elif slot.datatype == "Binary":
            single.append(struct(number, F.lit(None).cast("string"), slot.value))
        else:
            single.append(of_list(number, slot.value))
    return F.concat(F.array(*single).cast(_NUMBERED), *lists)


_NUMBERED = "array<struct<__slot:int,__text:string,__content:binary>>"


def edges(df: DataFrame, mapping: Mapping, catalog: Catalog, keep: Sequence[str] = ()) -> DataFrame:
    """Rows (destination, edge_set, edge_id, src_set, src_id, dst_set, dst_id).

    An edge is written wherever a property of its association is.
    """
    return edges_of(FanOut(df, mapping, catalog, keep))


def edges_of(fan: FanOut) -> DataFrame:
    """:func:`edges` of mapped rows."""
    mapping = fan.mapping
    if not mapping.associations:
        raise ValueError(f"mapping {mapping.name} has no associations")
    sets = {e.alias: e.entity_set for e in mapping.entities}

    def struct(a: Association, destination: str) -> Column:
        slots = [s for s in fan.slots[a.alias] if s.destination == destination]
        return F.when(
            fan.id(a.alias).isNotNull() & _any_present(slots),
            F.struct(
                F.lit(destination).alias("destination"),
                F.lit(a.entity_set).alias("edge_set"),
                fan.id(a.alias).alias("edge_id"),
                F.lit(sets[a.src]).alias("src_set"),
                fan.id(a.src).alias("src_id"),
                F.lit(sets[a.dst]).alias("dst_set"),
                fan.id(a.dst).alias("dst_id"),
            ),
        )

    structs = [
        struct(a, destination)
        for a in mapping.associations
        for destination in dict.fromkeys(s.destination for s in fan.slots[a.alias])
    ]
    return fan.explode(structs)


def print_row(row: Row, columns: Sequence[str]) -> Column:
    """The chosen columns of a row as one line; null is shown as the word."""
    cells = [F.coalesce(row[name].cast("string"), F.lit("null")) for name in columns]
    return F.concat_ws("\t|\t", *cells)


def rejects(
    df: DataFrame,
    mapping: Mapping,
    catalog: Catalog,
    shown: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows (row, alias, property, value, reason) for what could not be integrated.

    Reported are values that are not of their datatype, and definitions whose
    condition holds and which have values but a blank id.
    """
    return rejects_of(with_printed_rows(df, mapping, catalog, shown, keep))


PRINTED = "__printed_row"


def with_printed_rows(
    df: DataFrame, mapping: Mapping, catalog: Catalog, shown: Sequence[str], keep: Sequence[str] = ()
) -> FanOut:
    """Mapped rows that also have what :func:`rejects_of` shows of a row."""
    printed = df.withColumn(PRINTED, print_row(Row(df.columns), shown))
    return FanOut(printed, mapping, catalog, [*keep, PRINTED])


def rejects_of(fan: FanOut) -> DataFrame:
    """:func:`rejects` of mapped rows with printed rows."""
    mapping = fan.mapping

    def struct(d: Entity, name: str | None, value: Column, reason: str) -> Column:
        return F.struct(
            F.col(PRINTED).alias("row"),
            F.lit(d.alias).alias("alias"),
            F.lit(name).cast("string").alias("property"),
            value.alias("value"),
            F.lit(reason).alias("reason"),
        )

    found = []
    for d in mapping.definitions:
        for slot in (s for s in fan.slots[d.alias] if s.datatype not in ("Binary", "String")):
            if slot.many:
                wrong = F.filter(slot.value, partial(_is_wrong, slot.datatype))
                bad, is_bad = F.array_join(wrong, ","), F.size(wrong) > 0
            else:
                bad, is_bad = slot.value, _is_wrong(slot.datatype, slot.value)
            is_bad = fan.id(d.alias).isNotNull() & is_bad
            found.append(F.when(is_bad, struct(d, slot.prop.type, bad, f"not a {slot.datatype}")))
        found.append(F.when(fan.has_no_id(d), struct(d, None, F.lit(None).cast("string"), "blank id")))
    rows = copy(fan)
    rows.keep = fan.keep[:-1]
    return rows.explode(found)


def binary_envelope(c: Column) -> Column:
    """JSON text ``{"content-type": ..., "data": base64}`` of a binary value."""
    return F.to_json(
        F.struct(F.lit("application/octet-stream").alias("content-type"), base64_text(c).alias("data"))
    )


def to_destination(rows: DataFrame, destination: str) -> DataFrame:
    return rows.where(F.col("destination") == destination)
