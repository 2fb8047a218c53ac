"""Mappings, the catalog, and the fan-out of rows."""

import base64
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from graphloom.functions import steps
from graphloom.operators import counts, graph, ids
from graphloom.plans.catalog import Catalog, EntitySet, EntityType, PropertyType, not_in_catalog
from graphloom.plans.mapping import Association, Entity, Mapping, mapping_from_yaml, prop, read_yaml

# Tools that are lent out: a tool, the label on its box, and the loan that joins them.
CATALOG = Catalog.of(
    [PropertyType(n) for n in ("tool.name", "tool.finish", "tool.weight", "tool.mark")] + [PropertyType("loan.no", "Int32")],
    [EntityType("tool", ("tool.name",), ("tool.name", "tool.finish", "tool.weight", "tool.mark")),
     EntityType("loan", ("loan.no",), ("loan.no",), is_association=True)],
    [EntitySet("tools", "tool"), EntitySet("boxes", "tool"), EntitySet("loans", "loan")],
)
ROWS = [("saw", "steel", "900", "7"), ("saw", "steel", "650", "8"), ("saw", "brass", "900", "late"), ("file", " ", "120", None)]
TOOL = Entity("tool", "tools", (
    prop("tool.mark", steps.concat(["finish", "weight"], "/")), prop("tool.name", "name"), prop("tool.finish", "finish")))
BOX = Entity("box", "boxes", (prop("tool.name", "name", steps.case("upper")), prop("tool.weight", "weight")))
LOAN = Association("loan", "loans", (prop("loan.no", "loan"),), src="tool", dst="box")
MAPPING = Mapping("tools", (TOOL, BOX), (LOAN,))


def b64(text):
    return base64.b64encode(text.encode()).decode()


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "name string, finish string, weight string, loan string")


def values_of(df):
    return sorted((r.entity_set, r.entity_id, r.property, r.value) for r in df.collect())


def test_entities_and_edges(rows):
    values = graph.entity_values(rows, replace(MAPPING, entities=(
        replace(TOOL, properties=TOOL.properties[1:]), BOX)), CATALOG)
    expected = []
    for name, finish, weight, loan in ROWS:
        expected.append(("tools", b64(name), "tool.name", name))
        if finish.strip():
            expected.append(("tools", b64(name), "tool.finish", finish))
        expected.append(("boxes", b64(name.upper()), "tool.name", name.upper()))
        expected.append(("boxes", b64(name.upper()), "tool.weight", weight))
        if loan is not None and loan.isdigit():
            expected.append(("loans", b64(loan), "loan.no", loan))
    assert values_of(values) == sorted(expected)
    edges = [(r.edge_id, r.src_set, r.src_id, r.dst_set, r.dst_id) for r in graph.edges(rows, MAPPING, CATALOG).collect()]
    # The edge id is made of the raw value, also where that is no number.
    assert sorted(edges) == sorted(
        (b64(i), "tools", b64(a), "boxes", b64(a.upper())) for a, _, _, i in ROWS if i is not None)


def test_one_scan_without_shuffle(rows, spark, tmp_path):
    path = str(tmp_path / "rows")
    rows.write.parquet(path)
    read = spark.read.parquet(path)
    for made in (graph.entity_values(read, MAPPING, CATALOG), graph.edges(read, MAPPING, CATALOG)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan


def test_conditions_drop_entities_and_their_edges(rows):
    only_brass = replace(TOOL, condition=steps.equals("finish", "brass"))
    mapping = replace(MAPPING, entities=(only_brass, BOX))
    sets = [r.entity_set for r in graph.entity_values(rows, mapping, CATALOG).collect()]
    assert sets.count("tools") == 3 and sets.count("boxes") == 8
    assert graph.edges(rows, mapping, CATALOG).count() == 1
    assert graph.entity_values(rows, replace(MAPPING, condition=steps.equals("name", "none")), CATALOG).count() == 0
    one_loan = replace(LOAN, condition=steps.equals("loan", "8"))
    assert graph.edges(rows, replace(MAPPING, associations=(one_loan,)), CATALOG).count() == 1


def test_blank_generated_id_makes_no_entity(rows):
    generated = replace(TOOL, generator=(steps.column("finish"),))
    mapping = replace(MAPPING, entities=(generated, BOX), associations=())
    found = {r.entity_id for r in graph.entity_values(rows, mapping, CATALOG).where("entity_set = 'tools'").collect()}
    assert found == {"steel", "brass"}


def test_values_of_lists(spark):
    catalog = Catalog.of([PropertyType("p.k"), PropertyType("p.tags"), PropertyType("p.nums", "Int32")],
                         [EntityType("p", ("p.k", "p.tags"), ("p.k", "p.tags", "p.nums"))], [EntitySet("ps", "p")])
    df = spark.createDataFrame([("1", ["b", "a", "b", " ", None], ["1", "x"]), ("2", [], []), (None, [], [])],
                               "k string, tags array<string>, nums array<string>")
    mapping = Mapping("m", (Entity("p", "ps", (prop("p.k", "k"), prop("p.tags", "tags"), prop("p.nums", "nums"))),))
    one, two = f"{b64('1')}|{b64('a')},{b64('b')}", f"{b64('2')}|"
    assert values_of(graph.entity_values(df, mapping, catalog)) == sorted([
        ("ps", one, "p.k", "1"), ("ps", one, "p.tags", "a"), ("ps", one, "p.tags", "b"), ("ps", one, "p.nums", "1"),
        ("ps", two, "p.k", "2")])
    found = graph.rejects(df, mapping, catalog, ["k"])
    assert [(r.row, r.property, r.value) for r in found.where("reason <> 'blank id'").collect()] == [("1", "p.nums", "x")]


def test_bad_values_are_rejected_or_end_the_query(rows):
    found = graph.rejects(rows, MAPPING, CATALOG, ["name", "loan"], keep=["weight"]).collect()
    assert [(r.weight, r.row, r.alias, r.property, r.value, r.reason) for r in found] == [
        ("900", "saw\t|\tlate", "loan", "loan.no", "late", "not a Int32")]
    first = counts.earliest_reject(graph.rejects(rows, MAPPING, CATALOG, ["name"], keep=["weight"]), "weight").collect()
    assert len(first) == 1 and first[0].row == "saw"
    with pytest.raises(Exception, match="not a Int32"):
        graph.entity_values(rows, MAPPING, CATALOG, fail_on_bad_value=True).collect()


def test_binary_properties_take_bytes_only(spark):
    catalog = Catalog.of([PropertyType("d.k"), PropertyType("d.b", "Binary")],
                         [EntityType("d", ("d.k",), ("d.k", "d.b"))], [EntitySet("ds", "d")])
    mapping = Mapping("m", (Entity("d", "ds", (prop("d.k", "k"), prop("d.b", "b"))),))
    good = spark.createDataFrame([("1", bytearray(b"\x00\x01")), ("2", None)], "k string, b binary")
    found = {(r.property, r.destination, r.value, r.content) for r in graph.entity_values(good, mapping, catalog).collect()}
    assert found == {("d.k", "POSTGRES", "1", None), ("d.k", "POSTGRES", "2", None), ("d.b", "S3", None, b"\x00\x01")}
    bad = spark.createDataFrame([("1", "text")], "k string, b string")
    with pytest.raises(ValueError):
        graph.entity_values(bad, mapping, catalog)


def test_dotted_and_odd_column_names(spark):
    df = spark.createDataFrame([("x", "y")], "`a.b` string, `c``d` string")
    mapping = Mapping("m", (Entity("c", "tools", (prop("tool.name", "a.b"), prop("tool.finish", "c`d"))),))
    assert values_of(graph.entity_values(df, mapping, CATALOG, keep=["a.b"])) == [
        ("tools", b64("x"), "tool.finish", "y"), ("tools", b64("x"), "tool.name", "x")]


def test_rules_of_a_mapping():
    with pytest.raises(ValueError, match="no entities"):
        Mapping("m", ())
    with pytest.raises(ValueError, match="no properties"):
        Entity("a", "tools", ())
    with pytest.raises(ValueError, match="alias twice"):
        Mapping("m", (TOOL, TOOL))
    with pytest.raises(ValueError, match="property twice"):
        Entity("a", "tools", (prop("tool.name", "name"), prop("tool.name", "finish")))
    with pytest.raises(ValueError, match="no entity has the alias"):
        Mapping("m", (TOOL,), (LOAN,))
    with pytest.raises(ValueError, match="more than one update_type"):
        Mapping("m", (TOOL, replace(BOX, entity_set="tools", update_type="Replace"))).update_types()
    assert replace(MAPPING, entities=(replace(TOOL, update_type="Replace"), BOX)).update_types() == {
        "tools": "Replace", "boxes": "Merge", "loans": "Merge"}


def test_catalog_checks(spark):
    CATALOG.check(MAPPING)
    with pytest.raises(ValueError, match="does not exist"):
        CATALOG.check(Mapping("m", (replace(TOOL, entity_set="none"),)))
    with pytest.raises(ValueError, match="not in the catalog"):
        CATALOG.check(Mapping("m", (Entity("a", "tools", (prop("tool.none", "name"),)),)))
    with pytest.raises(ValueError, match="not defined for entity set"):
        CATALOG.check(Mapping("m", (Entity("a", "tools", (prop("loan.no", "loan"),)),)))
    known = CATALOG.property_frame(spark)
    assert known.count() == 9
    wanted = spark.createDataFrame([("tools", "tool.name"), ("tools", "loan.no")], "entity_set string, property string")
    assert [tuple(r) for r in not_in_catalog(wanted, known, ["entity_set", "property"]).collect()] == [("tools", "loan.no")]


def test_missing_entity_sets():
    new = replace(TOOL, entity_set="new", entity_type="tool", set_id="id-1")
    with pytest.raises(ValueError, match="organization"):
        CATALOG.missing_sets(Mapping("m", (new,)))
    made = CATALOG.missing_sets(Mapping("m", (new, BOX), organization_id="org"), ["b@x", "a@x"])
    assert [(s.name, s.type, s.id, s.contacts, s.organization_id) for s in made] == [
        ("new", "tool", "id-1", ("a@x", "b@x"), "org")]
    CATALOG.with_sets(made).check(Mapping("m", (new,)))


# The names of the file format's keys and tags. All else is this test's own.
CATALOG_FILE = """
propertyTypes:
  - datatype: "Date"
    properties:
      - {type: "shelf.since", title: "In use since"}
  - datatype: "String"
    analyzer: "STANDARD"
    pii: true
    properties:
      - {type: "shelf.code", title: "Code", description: "Painted on the side"}
entitySets:
  - {name: "shelves", type: "shelf", title: "All shelves", contacts: ["store@example.org", "night@example.org"]}
entityTypes:
  - {type: "shelf", key: ["shelf.code"], properties: ["shelf.code", "shelf.since"]}
associationTypes:
  - entityType: {type: "stands.by", properties: ["shelf.since"], key: ["shelf.since"]}
    bidirectional: true
    dst: ["shelf"]
    src: ["shelf"]
"""


def test_catalog_from_a_file():
    catalog = Catalog.from_dict(read_yaml(CATALOG_FILE))
    assert catalog.property_types["shelf.code"].analyzer == "STANDARD" and catalog.property_types["shelf.code"].pii
    assert catalog.datatype("shelf.since") == "Date" and not catalog.property_types["shelf.since"].pii
    assert catalog.set_type("shelves").key == ("shelf.code",) and len(catalog.entity_sets["shelves"].contacts) == 2
    assert catalog.entity_types["stands.by"].bidirectional and catalog.entity_types["stands.by"].is_association


MAPPING_FILE = """
name: "tools"
associationDefinitions:
  lent:
    entitySetName: "loans"
    src: "labelled"
    dst: "plain"
    updateType: Replace
    propertyDefinitions:
      loan.no: {type: "loan.no", column: "loan"}
entityDefinitions:
  plain:
    entitySetName: "boxes"
    updateType: PartialReplace
    propertyUpdateType: Unversioned
    propertyDefinitions:
      tool.weight: {type: "tool.weight", column: "weight"}
      tool.name:
        type: "tool.name"
        transforms:
          - !<transforms.ConcatTransform> {columns: ["name", "finish"], separator: " of "}
  labelled:
    entitySetName: "tools"
    generator: !<generators.TransformSeriesGenerator>
      transforms:
        - !<transforms.ColumnTransform> {column: "name"}
        - !<transforms.ValueTransform> {value: "one for all"}
    propertyDefinitions:
      tool.finish: {type: "tool.finish"}
      tool.name: {type: "tool.name", column: "name"}
condition:
  - !<conditions.BooleanIsNullCondition> {column: "loan"}
  - !<conditions.ConditionalOr> {}
  - !<conditions.BooleanRegexCondition> {column: "weight", pattern: "^9"}
"""


def test_mapping_from_a_file(rows):
    mapping = mapping_from_yaml(MAPPING_FILE)
    assert mapping.update_types() == {"tools": "Merge", "boxes": "PartialReplace", "loans": "Replace"}
    assert mapping.property_update_types() == {"tools": "Versioned", "boxes": "Unversioned", "loans": "Versioned"}
    values = graph.entity_values(rows, mapping, CATALOG)
    found = {(r.entity_set, r.entity_id) for r in values.where("entity_set <> 'loans'").collect()}
    # The last step of a generator gives the id; a definition without a source has no values.
    names = [f"{n} of {f}" for n, f, w, i in ROWS if w[0] == "9" or i is None]
    assert found == {("tools", "one for all"), *[("boxes", b64(n)) for n in names]}
    assert not values.where("property = 'tool.finish'").count()
    assert graph.edges(rows, mapping, CATALOG).count() == 2


def test_counts(rows):
    values, edges = graph.entity_values(rows, MAPPING, CATALOG), graph.edges(rows, MAPPING, CATALOG)
    found = counts.counts_by_destination(values, edges).collect()
    assert [(r.destination, r.entities, r.edges) for r in found] == [("POSTGRES", 2 + 2 + 2, 3)]
    watched, counter = counts.observed(rows)
    watched.write.format("noop").mode("overwrite").save()
    assert counter.get == {"rows": 4}


def test_last_row_wins(spark):
    values = spark.createDataFrame(
        [("s", "a", "p", 1, 1, "old"), ("s", "a", "q", 1, 2, "kept?"), ("s", "a", "p", 2, 3, "new"), ("s", "b", "p", 1, 4, "one"),
         ("s", "c", "p", None, 5, "no order"), ("s", "c", "q", None, 5, "same row"), ("s", "d", "p", None, 6, "null first"),
         ("s", "d", "p", 0, 7, "any value"), ("s", "e", "p", 3, 8, "tie"), ("s", "e", "p", 3, 9, "tie, later row"), (None, "f", "p", 1, 1, "null set")],
        "entity_set string, entity_id string, property string, at int, row int, value string")
    last = {(r.entity_id, r.property, r.value) for r in counts.last_row_wins(values, ["at", "row"]).collect()}
    assert last == {("a", "p", "new"), ("b", "p", "one"), ("c", "p", "no order"), ("c", "q", "same row"),
                    ("d", "p", "any value"), ("e", "p", "tie, later row"), ("f", "p", "null set")}
    tied = counts.last_row_wins(values, "at").where("entity_id = 'e'")
    assert tied.count() == 2


def test_explicit_ids_win(spark):
    given = "00000000-0000-0000-0000-00000000000a"
    values = spark.createDataFrame(
        [("s", "a", "p", "POSTGRES", "1", None), ("s", "a", "@id", "POSTGRES", given, None), ("s", "b", "p", "POSTGRES", "2", None)],
        "entity_set string, entity_id string, property string, destination string, value string, content binary")
    registry = spark.createDataFrame([("s", "a", "old-a"), ("s", "b", "old-b")], "entity_set string, entity_id string, key_id string")
    found = ids.assign_ids(values, registry).collect()
    assert sorted((r.entity_id, r.property, r.key_id) for r in found) == [("a", "p", given), ("b", "p", "old-b")]


def test_address_lookup(spark):
    rows = spark.createDataFrame([(1, "12 Mill Lane, Upper Ham"), (2, "nowhere"), (3, " "), (4, None)], "id int, address string")
    gazetteer = spark.createDataFrame(
        [("12 MILL LANE -- upper ham", "Mill Lane", "12", "52.5,1.25"), ("12 mill lane upper ham", "Mill Lane", "12b", "0,0"), ("", "x", "x", "x")],
        "address string, road string, number string, point string")
    found = ids.look_up_address(rows, "address", gazetteer, ["road", "number", "point"])
    assert sorted(tuple(r)[0:1] + tuple(r)[2:] for r in found.collect()) == [
        (1, "Mill Lane", "12", "52.5,1.25"), (2, None, None, None), (3, None, None, None), (4, None, None, None)]


def test_wide_mapping(spark):
    names = [f"w.{i}" for i in range(150)]
    catalog = Catalog.of([PropertyType(n, "Int32" if i % 2 else "String") for i, n in enumerate(names)],
                         [EntityType("w", ("w.0",), tuple(names))], [EntitySet("ws", "w")])
    df = spark.range(20).select(*[(F.col("id") + i).cast("string").alias(n) for i, n in enumerate(names)])
    mapping = Mapping("wide", (Entity("w", "ws", tuple(prop(n) for n in names)),))
    found = graph.entity_values(df, mapping, catalog).groupBy("property").agg(F.sum("value").alias("n")).collect()
    assert {r.property: int(r.n) for r in found} == {n: sum(range(20)) + 20 * i for i, n in enumerate(names)}
