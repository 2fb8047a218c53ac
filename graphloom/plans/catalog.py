"""The catalog: property types, entity types and entity sets, and the checks against it.

A catalog is metadata written by people and small enough for the driver. The
DataFrame checks take any number of rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from graphloom.functions.types import SPARK_TYPES
from graphloom.plans.mapping import BINARIES, Mapping

ID_PROPERTY = "@id"


@dataclass(frozen=True)
class PropertyType:
    name: str
    datatype: str = "String"
    pii: bool = False
    analyzer: str | None = None
    title: str = ""
    description: str = ""

    def __post_init__(self) -> None:
        if self.datatype not in SPARK_TYPES:
            raise ValueError(f"property type {self.name}: unknown datatype {self.datatype!r}")


@dataclass(frozen=True)
class EntityType:
    """An entity type or, with ``is_association``, an association type."""

    name: str
    key: tuple[str, ...]
    properties: tuple[str, ...]
    title: str = ""
    description: str = ""
    base_type: str | None = None
    is_association: bool = False
    src: tuple[str, ...] = ()
    dst: tuple[str, ...] = ()
    bidirectional: bool = False


@dataclass(frozen=True)
class EntitySet:
    name: str
    type: str
    title: str = ""
    description: str = ""
    contacts: tuple[str, ...] = ()
    id: str | None = None
    organization_id: str | None = None


@dataclass(frozen=True)
class Catalog:
    property_types: dict[str, PropertyType] = field(default_factory=dict)
    entity_types: dict[str, EntityType] = field(default_factory=dict)
    entity_sets: dict[str, EntitySet] = field(default_factory=dict)

    @staticmethod
    def of(
        property_types: Iterable[PropertyType],
        entity_types: Iterable[EntityType],
        entity_sets: Iterable[EntitySet],
    ) -> Catalog:
        return Catalog(
            {p.name: p for p in property_types},
            {t.name: t for t in entity_types},
            {s.name: s for s in entity_sets},
        )

    @staticmethod
    def from_dict(spec: dict[str, Any]) -> Catalog:
        """A catalog from the layout of catalog files: groups of property types that share a
        datatype, then entity types, association types and entity sets."""
        shared = ("datatype", "pii", "analyzer")
        properties = [
            PropertyType(
                name=p["type"],
                title=p.get("title") or "",
                description=p.get("description") or "",
                **{k: group[k] for k in shared if k in group},
            )
            for group in spec.get("propertyTypes") or ()
            for p in group["properties"]
        ]
        types = [_type_from(t) for t in spec.get("entityTypes") or ()]
        for a in spec.get("associationTypes") or ():
            made = _type_from(a.get("entityType", a))
            types.append(
                replace(
                    made,
                    is_association=True,
                    src=tuple(a.get("src") or ()),
                    dst=tuple(a.get("dst") or ()),
                    bidirectional=bool(a.get("bidirectional")),
                )
            )
        sets = [
            EntitySet(
                name=s["name"],
                type=s["type"],
                title=s.get("title") or "",
                description=s.get("description") or "",
                contacts=tuple(s.get("contacts") or ()),
            )
            for s in spec.get("entitySets") or ()
        ]
        return Catalog.of(properties, types, sets)

    def set_type(self, entity_set: str) -> EntityType:
        if entity_set not in self.entity_sets:
            raise ValueError(f"entity set {entity_set} does not exist")
        return self.entity_types[self.entity_sets[entity_set].type]

    def datatype(self, property_name: str) -> str:
        if property_name == ID_PROPERTY:
            return "Guid"
        return self.property_types[property_name].datatype

    def check(self, mapping: Mapping) -> None:
        """Raise unless every entity set and property of the mapping is known and fits."""
        for d in mapping.definitions:
            allowed = set(self.set_type(d.entity_set).properties) | set(self.set_type(d.entity_set).key)
            names = [p.type for p in d.properties if p.type != ID_PROPERTY]
            unknown = [n for n in names if n not in self.property_types]
            if unknown:
                raise ValueError(f"properties not in the catalog: {unknown}")
            foreign = [n for n in names if n not in allowed]
            if foreign:
                raise ValueError(f"properties {foreign} are not defined for entity set {d.entity_set}")
            texts = [p.type for p in d.properties if p.destination == BINARIES and self.datatype(p.type) != "Binary"]
            if texts:
                raise ValueError(f"properties {texts} are not binary and cannot go to {BINARIES}")

    def missing_sets(self, mapping: Mapping, contacts: Iterable[str] = ()) -> list[EntitySet]:
        """Entity sets the mapping needs and the catalog lacks, ready to be added."""
        missing: dict[str, EntitySet] = {}
        for d in mapping.definitions:
            if d.entity_set in self.entity_sets or d.entity_set in missing:
                continue
            if not mapping.organization_id:
                raise ValueError(f"mapping {mapping.name} has no organization id for new entity sets")
            if d.entity_type not in self.entity_types:
                raise ValueError(f"entity type {d.entity_type} does not exist")
            missing[d.entity_set] = EntitySet(
                name=d.entity_set,
                type=d.entity_type,
                title=d.entity_set,
                description=d.entity_set,
                contacts=tuple(sorted(set(contacts))),
                id=d.set_id or str(uuid.uuid4()),
                organization_id=mapping.organization_id,
            )
        return list(missing.values())

    def with_sets(self, sets: Iterable[EntitySet]) -> Catalog:
        return replace(self, entity_sets={**self.entity_sets, **{s.name: s for s in sets}})

    def property_frame(self, spark: SparkSession) -> DataFrame:
        """One row per (entity set, property) with the datatype and flags."""
        rows = [
            (s.name, p, self.datatype(p), self.property_types[p].pii, self.property_types[p].analyzer)
            for s in self.entity_sets.values()
            for p in dict.fromkeys((*self.entity_types[s.type].key, *self.entity_types[s.type].properties))
        ]
        schema = "entity_set string, property string, datatype string, pii boolean, analyzer string"
        return spark.createDataFrame(rows, schema)


def _type_from(spec: dict[str, Any]) -> EntityType:
    return EntityType(
        name=spec["type"],
        key=tuple(spec.get("key") or ()),
        properties=tuple(spec.get("properties") or ()),
        title=spec.get("title") or "",
        description=spec.get("description") or "",
        base_type=spec.get("baseType"),
    )


def not_in_catalog(required: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys that are required but not known, such as the properties seen in a
    property store that their entity set does not have."""
    wanted = required.select(*keys).distinct()
    return wanted.join(known.select(*keys).distinct(), keys, "left_anti")
