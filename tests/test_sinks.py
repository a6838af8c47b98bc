import json
from datetime import date
from pathlib import Path

import pytest
from conftest import rows

from adjudica.session import materialise, shared_dir
from adjudica.sinks import contract, files, relational
from adjudica.sources.layouts import CONTRACT, CONTRACT_COLUMNS, contract_schema

ROW = (
    "uid string, modification_id smallint, dateNotification date, acheteur_id string, acheteur_nom string, titulaire_id string, "
    "titulaire_typeIdentifiant string, titulaire_nom string"
)


@pytest.fixture
def published(frame):
    return frame(
        ROW,
        ("1", 0, date(2023, 1, 1), "b1", "B1", "h1", "SIRET", "H1"),
        ("1", 0, date(2023, 1, 1), "b1", "B1", "h2", "TVA", "H2"),
        ("1", 1, date(2023, 2, 1), "b1", "B1", "h1", "SIRET", "H1"),
        ("2", 0, date(2023, 3, 1), "b1", "B1", "h1", "SIRET", "H1"),
    )


def test_table_is_written_in_both_formats(spark, published, tmp_path):
    path = str(tmp_path / "out")
    assert rows(files.write_table(published, path)) == rows(published)
    again = spark.read.schema(published.schema).csv(f"{path}.csv", header=True)
    assert rows(again) == rows(published)
    assert any(".zstd." in p.name for p in Path(f"{path}.parquet").iterdir())


def test_months_are_folders(spark, frame, tmp_path):
    df = frame("id int, d string", (1, "2024-05-06"), (2, "2024-06-01"))
    files.write_by_month(df, str(tmp_path / "m"), "d", "collector")
    assert {p.name for p in (tmp_path / "m").glob("month=*")} == {"month=2024-05", "month=2024-06"}
    assert {r.source for r in spark.read.json(str(tmp_path / "m")).collect()} == {"collector"}


def test_related_tables(published, tmp_path):
    tables = relational.related_tables(published)
    counts = {name: t.df.count() for name, t in tables.items()}
    assert counts == {"marches": 3, "acheteurs": 1, "entreprises": 2, "marches_titulaires": 4, "marches_acheteurs": 3}
    assert tables["acheteurs"].df.columns == ["id", "nom"]
    relational.write_related_tables(published, str(tmp_path))
    doubled = published.unionByName(published)
    with pytest.raises(ValueError):
        relational.write_related_tables(doubled, str(tmp_path / "again"))


def test_contract(spark, published, tmp_path):
    assert len(CONTRACT_COLUMNS) == len(set(CONTRACT_COLUMNS)) == 58
    assert contract_schema()["uid"].metadata["title"] == "Identifiant unique"
    df = published.selectExpr("uid", "modification_id", "dateNotification", "1 as unexpected")
    found = contract.described(df, contract.base_contract(df))
    assert found.count() == len(CONTRACT)
    assert rows(found.where("actual_type is not null"), "name", "type", "actual_type") == [
        ("dateNotification", "date", "date"),
        ("modification_id", "integer", "integer"),
        ("uid", "string", "string"),
    ]
    (tmp_path / "base.json").write_text(json.dumps({"fields": [{"name": "uid", "title": "U", "type": "string", "description": "d", "x": 1}, {"name": "untitled"}]}))
    given = contract.described(df, contract.read_contract(spark, str(tmp_path / "base.json")), ["title", "description"])
    assert rows(given, "name", "title", "description", "actual_type") == [("uid", "U", "d", "string")]
    declared = {r.name: r.type for r in found.collect()}
    assert (declared["acheteur_id"], declared["montant"], declared["dureeMois"]) == ("integer", "number", "integer")
    files.write_document(contract.contract_document(df, contract.base_contract(df)), str(tmp_path / "schema"))
    (file,) = (tmp_path / "schema").glob("*.json")
    assert len(json.loads(file.read_text())["fields"]) == 58


def test_work_goes_to_the_shared_folder(spark, published):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    copy = materialise(published)
    assert rows(copy) == rows(published)
    assert "LocalTableScan" not in copy._jdf.queryExecution().executedPlan().toString()
    assert copy.inputFiles()[0].startswith("file://" + shared_dir(spark))


def test_related_tables_with_distances_are_written_once_all_keys_are_sound(spark, frame, tmp_path):
    columns = "uid string, modification_id short, acheteur_id string, titulaire_id string, titulaire_typeIdentifiant string, titulaire_nom string, titulaire_distance short"
    sound = frame(columns, ("u1", 0, "b1", "s", "SIRET", "S", 5), ("u2", 0, "b2", "s", "SIRET", "S", 9))
    relational.write_related_tables(sound, str(tmp_path / "good"))
    assert spark.read.parquet(str(tmp_path / "good" / "entreprises.parquet")).columns == ["id", "typeIdentifiant", "nom"]
    distances = spark.read.parquet(str(tmp_path / "good" / "marches_titulaires.parquet"))
    assert sorted(r.titulaire_distance for r in distances.collect()) == [5, 9]
    twofold = sound.union(frame(columns, ("u3", 0, "b1", "s", "SIRET", "Other", 5)))
    with pytest.raises(Exception):
        relational.write_related_tables(twofold, str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists()
