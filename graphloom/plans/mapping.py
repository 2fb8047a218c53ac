"""Mappings: which entities and associations each source row turns into."""

from __future__ import annotations

from collections.abc import Mapping as MappingType
from dataclasses import dataclass
from typing import Any

from graphloom.functions import steps
from graphloom.functions.conditions import AND, OR
from graphloom.functions.steps import Chain, Condition, Step

# Update types, property update types and destinations.
UPDATE_TYPES = ("Merge", "Replace", "PartialReplace")
REPLACING = ("Replace", "PartialReplace")
PROPERTY_UPDATE_TYPES = ("Versioned", "Unversioned")
NO_OP, TABLES, BINARIES = "NO_OP", "POSTGRES", "S3"
DESTINATIONS = ("NO_OP", "POSTGRES", "REST", "S3")


@dataclass(frozen=True)
class Property:
    """A property and the chain that gives its value."""

    type: str
    chain: Chain
    destination: str | None = None

    def __post_init__(self) -> None:
        if not self.chain:
            raise ValueError(f"property {self.type} has neither a column nor transforms")
        if self.destination is not None and self.destination not in DESTINATIONS:
            raise ValueError(f"unknown destination {self.destination!r}")


@dataclass(frozen=True)
class Entity:
    alias: str
    entity_set: str
    properties: tuple[Property, ...]
    generator: Chain | None = None
    condition: Condition | None = None
    update_type: str = "Merge"
    property_update_type: str = "Versioned"
    associate_only: bool = False
    entity_type: str | None = None
    set_id: str | None = None

    def __post_init__(self) -> None:
        if not self.properties:
            raise ValueError(f"{self.alias} has no properties")
        names = [p.type for p in self.properties]
        if len(set(names)) < len(names):
            raise ValueError(f"{self.alias} has a property twice")
        if self.update_type not in UPDATE_TYPES:
            raise ValueError(f"unknown update type {self.update_type!r}")
        if self.property_update_type not in PROPERTY_UPDATE_TYPES:
            raise ValueError(f"unknown property update type {self.property_update_type!r}")


@dataclass(frozen=True)
class Association(Entity):
    src: str = ""
    dst: str = ""


@dataclass(frozen=True)
class Mapping:
    name: str
    entities: tuple[Entity, ...]
    associations: tuple[Association, ...] = ()
    condition: Condition | None = None
    tags: tuple[str, ...] = ()
    organization_id: str | None = None

    def __post_init__(self) -> None:
        if not self.entities:
            raise ValueError(f"mapping {self.name} has no entities")
        aliases = [d.alias for d in self.definitions]
        if len(set(aliases)) < len(aliases):
            raise ValueError(f"mapping {self.name} has an alias twice")
        known = {e.alias for e in self.entities}
        for a in self.associations:
            for end in (a.src, a.dst):
                if end not in known:
                    raise ValueError(f"association {a.alias}: no entity has the alias {end!r}")

    @property
    def definitions(self) -> tuple[Entity, ...]:
        return (*self.entities, *self.associations)

    def update_types(self) -> dict[str, str]:
        """Update type of each entity set; definitions of one set must agree."""
        return self._by_set("update_type")

    def property_update_types(self) -> dict[str, str]:
        return self._by_set("property_update_type")

    def _by_set(self, attribute: str) -> dict[str, str]:
        found: dict[str, str] = {}
        for d in self.definitions:
            kind = getattr(d, attribute)
            if found.setdefault(d.entity_set, kind) != kind:
                raise ValueError(f"entity set {d.entity_set} has more than one {attribute}")
        return found


def prop(
    type: str,
    source: str | Step | Chain | Any = None,
    *transforms: Step,
    destination: str | None = None,
) -> Property:
    """A property from a column name, a step, a chain or a function of the row."""
    if source is None:
        source = type
    if isinstance(source, str):
        start: Chain = (steps.column(source),)
    elif isinstance(source, Step):
        start = (source,)
    elif callable(source):
        start = (steps.extractor(source),)
    else:
        start = tuple(source)
    return Property(type, (*start, *transforms), destination)


def condition_of(spec: Any) -> Condition | None:
    """A condition from a function of the row, a spec, or a list of both with markers."""
    if spec is None:
        return None
    if isinstance(spec, (list, tuple)):
        items = [steps.condition_from(s) if not isinstance(s, str) else s for s in spec]
        return steps.fold(items) if any(i not in (AND, OR) for i in items) else None
    made = steps.condition_from(spec)
    return None if isinstance(made, str) else made


def mapping_from(spec: MappingType[str, Any]) -> Mapping:
    """A mapping from the layout of mapping files."""

    def properties(d: MappingType[str, Any]) -> tuple[Property, ...]:
        made = []
        for name, p in (d.get("propertyDefinitions") or {}).items():
            chain = list(steps.chain_from(p.get("transforms") or ()))
            if p.get("column"):
                chain.insert(0, steps.column(p["column"]))
            # A definition with neither a column nor transforms never has a value.
            chain = chain or [steps.value(None)]
            made.append(Property(p.get("type", name), tuple(chain), p.get("storageDestination")))
        return tuple(made)

    def common(alias: str, d: MappingType[str, Any]) -> dict[str, Any]:
        generator = d.get("generator")
        return {
            "alias": d.get("name") or alias,
            "entity_set": d["entitySetName"],
            "properties": properties(d),
            "generator": steps.chain_from(generator["transforms"]) if generator else None,
            "condition": condition_of(d.get("condition")),
            "update_type": d.get("updateType") or "Merge",
            "property_update_type": d.get("propertyUpdateType") or "Versioned",
            "associate_only": bool(d.get("associateOnly")),
            "entity_type": d.get("fqn"),
            "set_id": d.get("id"),
        }

    entities = tuple(Entity(**common(a, d)) for a, d in (spec.get("entityDefinitions") or {}).items())
    associations = tuple(
        Association(**common(a, d), src=d["src"], dst=d["dst"])
        for a, d in (spec.get("associationDefinitions") or {}).items()
    )
    return Mapping(
        name=spec.get("name") or "",
        entities=entities,
        associations=associations,
        condition=condition_of(spec.get("condition")),
        tags=tuple(spec.get("tags") or ()),
        organization_id=spec.get("organizationId"),
    )


def read_yaml(text: str) -> Any:
    """YAML whose tags name steps and conditions: ``!<any.Name>`` becomes ``kind: Name``."""
    import yaml

    class Loader(yaml.SafeLoader):
        pass

    def tagged(loader: Any, suffix: str, node: Any) -> Any:
        kind = suffix.rsplit(".", 1)[-1]
        if isinstance(node, yaml.MappingNode):
            return {"kind": kind, **loader.construct_mapping(node, deep=True)}
        return {"kind": kind}

    Loader.add_multi_constructor("", tagged)
    return yaml.load(text, Loader)


def mapping_from_yaml(text: str) -> Mapping:
    return mapping_from(read_yaml(text))
