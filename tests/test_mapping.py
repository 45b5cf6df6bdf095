import json

import pytest

from tidemark.sources.mapping import Mapping

DATA = {"data": [
    {"source_table": "users", "dest_table": "users", "topic": "u"},
    {"source_table": "web", "dest_table": "contacts", "remap": {"id": "{id}", "source": "web", "rank": 3}},
    {"source_table": "app", "dest_table": "contacts", "topic": "c", "remap": {}},
    {"source_table": "web", "dest_table": "audit", "topic": "c"},
    {"source_table": "hooks", "script": {"module": "Shop.Hooks", "function": "run"}},
]}


@pytest.fixture
def path(tmp_path):
    file = tmp_path / "mapper.json"
    file.write_text(json.dumps(DATA))
    return str(file)


def test_load_from_argument_environment_or_folder(path, tmp_path, monkeypatch):
    assert len(Mapping.load(path)) == 5
    monkeypatch.setenv("MAPPER_FILE", path)
    assert len(Mapping.load()) == 5
    monkeypatch.delenv("MAPPER_FILE")
    monkeypatch.chdir(tmp_path)
    assert len(Mapping.load()) == 5


def test_lookups(path):
    mapping = Mapping.load(path)
    assert mapping.tables() == ["users", "web", "app", "web", "hooks"]
    assert mapping.distinct_tables() == ["users", "web", "app", "hooks"]
    assert mapping.topics() == ["u", None, "c", "c", None]
    assert mapping.by_topic("c").source_table == "app"
    assert mapping.by_topic("none") is None
    assert [e.dest_table for e in mapping.by_source("web")] == ["contacts", "audit"]
    assert mapping.by_source("none") == []
    assert mapping.destinations() == ["users", "contacts", "audit"]
    assert mapping.by_source("hooks")[0].script == "Shop.Hooks.run"


def test_absent_and_empty_remap_differ(path):
    mapping = Mapping.load(path)
    assert mapping.by_source("users")[0].remap is None
    assert mapping.by_source("app")[0].remap == {}


def test_frame(spark, path):
    rows = Mapping.load(path).frame(spark).orderBy("entry_no").collect()
    assert [r["source_table"] for r in rows] == ["users", "web", "app", "web", "hooks"]
    assert rows[0]["remap"] is None and rows[2]["remap"] == {}
    assert rows[1]["remap"] == {"id": "{id}", "source": "web", "rank": "3"}
    assert tuple(rows[4]["script"]) == ("Shop.Hooks", "run")
