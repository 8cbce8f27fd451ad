import pytest
import yaml
from pyspark.sql import types as T

from oreflow import load_contract, parse_contract, read_steps
from oreflow.contracts import Check, selected

COLUMNS = [{"name": "id", "type": "INTEGER", "nullable": False}, {"name": "v", "source": "w"}]


def contract(**table):
    section = {"table": "t", "source_table": "raw_t", "columns": COLUMNS, **table}
    return parse_contract({"persistent": [section]})


def test_defaults():
    spec = contract().persistent[0]
    assert (spec.name, spec.target_table, spec.keys, spec.update_mode) == (
        "t", "t", (), "incremental_upsert",
    )
    assert spec.rejects_table == "t__quarantine"
    assert [c.source for c in spec.columns] == ["id", "w"]
    assert spec.schema == T.StructType(
        [T.StructField("id", T.LongType(), False), T.StructField("v", T.StringType(), True)]
    )


def test_single_mapping_takes_the_raw_table_and_its_checks():
    document = {
        "raw": {"table": "r", "data_quality_checks": [{"check": "NOT_NULL", "column": "id"}]},
        "persistent": {"table": "t", "columns": COLUMNS, "primary_keys": ["id"]},
    }
    spec = parse_contract(document).persistent[0]
    assert spec.source_table == "r" and spec.keys == ("id",)
    assert spec.checks == (Check("not_null", ("id",)),)


def test_own_checks_replace_inherited_ones_and_global_rules_are_added():
    document = {
        "raw": {"table": "r", "data_quality_checks": [{"rule": "not_null", "column": "v"}]},
        "persistent": {"table": "t", "columns": COLUMNS, "data_quality_checks": []},
        "quality": {"rules": [{"rule": "non_negative", "columns": ["id", "other"]}]},
    }
    assert parse_contract(document).persistent[0].checks == (Check("non_negative", ("id",)),)


def test_shared_columns_and_layer_references(tmp_path):
    (tmp_path / "tables").mkdir()
    (tmp_path / "tables" / "t.yml").write_text(
        yaml.safe_dump({"table_name": "t", "primary_keys": ["id"]}), encoding="utf-8"
    )
    (tmp_path / "tables" / "r.yml").write_text("table_name: r\n", encoding="utf-8")
    path = tmp_path / "contract.yml"
    references = {"raw": "tables/r.yml", "persistent": "tables/t.yml"}
    document = {"table_metadata": references, "columns": COLUMNS}
    path.write_text(yaml.safe_dump(document), encoding="utf-8")
    spec = load_contract(path).persistent[0]
    assert (spec.source_table, spec.target_table, spec.keys) == ("r", "t", ("id",))


@pytest.mark.parametrize(
    "change,message",
    [
        ({"columns": []}, "no columns"),
        ({"primary_keys": ["nope"]}, "unmapped"),
        ({"data_quality_checks": [{"rule": "is_even", "column": "id"}]}, "unknown data quality"),
        ({"data_quality_checks": [{"rule": "not_null", "column": "nope"}]}, "unmapped"),
        ({"data_quality_checks": [{"rule": "not_null"}]}, "names no column"),
        ({"table_update_mode": "sideways"}, "update mode"),
        ({"strategy": "SCD1"}, "SCD1 needs"),
        ({"dedup_scope": "week"}, "dedup_scope"),
        ({"source_table": None}, "source table"),
    ],
)
def test_contract_errors(change, message):
    with pytest.raises(ValueError, match=message):
        contract(**change)


def test_scd1_gate():
    spec = contract(
        strategy="SCD1", primary_keys=["v"], update_when="incoming.id > current.id"
    ).persistent[0]
    assert (spec.update_mode, spec.version_column, spec.lineage) == ("scd1", "id", True)
    with pytest.raises(ValueError, match="update_when"):
        contract(strategy="SCD1", primary_keys=["v"], update_when="incoming.id >= current.id")


@pytest.mark.parametrize("item", [{}, {"sql": "select 1", "mapping": "select 1"}])
def test_consumption_takes_exactly_one_text(item):
    with pytest.raises(ValueError, match="exactly one"):
        parse_contract({"consumption": {"name": "x", **item}})


def test_landing_names():
    document = {
        "landing": {"file_pattern": "A_*.csv", "raw_table": "r"},
        "source": {"encoding": "utf-8-sig", "delimiter": ";"},
    }
    landing = parse_contract(document).landing
    assert (landing.pattern, landing.encoding, landing.delimiter) == ("A_*.csv", "UTF-8", ";")
    with pytest.raises(ValueError, match="sha256"):
        parse_contract({"source": {"checksum": "md5"}})


def test_selection_strips_the_layer():
    specs = contract().persistent
    assert selected(specs, ["persistent.t"], lambda s: s.target_table) == list(specs)
    assert selected(specs, None, lambda s: s.target_table) == list(specs)
    with pytest.raises(ValueError, match="no table"):
        selected(specs, ["persistent.u"], lambda s: s.target_table)


def test_steps_from_yaml(tmp_path):
    path = tmp_path / "flow.yml"
    steps = [
        {"name": "a", "path": "pkg/steps:landing_to_raw"},
        {"process_name": "b", "processor": "mine", "depends_on": ["a"], "parameters": {"x": 1}},
    ]
    path.write_text(yaml.safe_dump({"steps": steps}), encoding="utf-8")
    read = read_steps(path, {"mine": print})
    assert [s.name for s in read] == ["a", "b"] and read[1].function is print
    with pytest.raises(ValueError, match="no function"):
        read_steps(path)
