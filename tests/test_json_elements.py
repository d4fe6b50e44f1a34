"""A JSON document read by many tasks against Spark's own one-task reader."""

import json
import random

import pytest
from pyspark.sql import functions as F

from civgraph.sources import json_elements as J
from civgraph.sources.blocks import pieces
from civgraph.sources.contracts import CONTRACT_ARRAYS, CONTRACT_DOCUMENT_SCHEMA
from civgraph.sources.prep import post, split_contract_document, write_contract_document
from civgraph.sources.readers import read_contract_document


@pytest.fixture
def splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")
    old = {n: spark.conf.get(n) for n in names}

    def to(size, batch=5):
        for n, v in zip(names, (size, size, batch)):
            spark.conf.set(n, str(v))
    yield to
    for n, v in old.items():
        spark.conf.set(n, v)


def word(r):
    return "".join(r.choice(["a", "é", '"', "\\", "{", "}", "[", "]", ",", ":", "\n", '": [', '\\"', "marche", " "])
                   for _ in range(r.randrange(8)))


def document(seed, n):
    r = random.Random(seed)
    party = lambda k: {k: {"typeIdentifiant": "SIRET", "id": word(r)}}
    markets = [{"id": f"m{i}", "objet": word(r), "acheteur": {"id": word(r)}, "montant": r.choice([3, 2.5, "NC", None]),
                "techniques": {"technique": [word(r) for _ in range(r.randrange(3))]},
                "titulaires": [party("titulaire") for _ in range(r.randrange(3))], "marche": [{"x": "nested"}],
                "unknown": {"marches": {"marche": [{"id": "no"}]}}} for i in range(n)]
    grants = [{"id": f"c{i}", "objet": word(r), "concessionnaires": [party("concessionnaire")]} for i in range(n // 2)]
    return {"before": {"marche": [{"id": "not here"}], word(r): [[{"id": "nor here"}]]},
            "marches": {"other": [{"id": "no"}, {}], "marche": markets, "more": {"deep": {"id": "no"}},
                        "contrat-concession": grants, "last": [1, [{"id": "no"}]]}, "after": [{"marche": [{"id": "no"}]}]}


def rows(df):
    return sorted((json.dumps(x.asDict(True), sort_keys=True) for x in df.collect()))


def want(spark, path):
    doc = spark.read.schema(CONTRACT_DOCUMENT_SCHEMA).option("multiLine", True).json(str(path))
    return {"marche": rows(doc.select(F.inline("marches.marche"))),
            "concession": rows(doc.select(F.inline("marches.`contrat-concession`")))}


@pytest.mark.parametrize("size,indent", [(97, None), (151, 1), (10**6, 2)])
def test_equals_the_one_task_reader(spark, tmp_path, splits, size, indent):
    path = tmp_path / "commande-publique-france_2026.json"
    path.write_text(json.dumps(document(size, 12), ensure_ascii=False, indent=indent))
    expected = want(spark, path)
    assert len(expected["marche"]) == 12 and len(expected["concession"]) == 6
    splits(size)
    if size < 1000:
        assert pieces(spark, [str(path)], "{").rdd.getNumPartitions() > 10
    doc = read_contract_document(spark, str(path))
    got = {k: rows(df) for k, df in split_contract_document(doc).items()}
    assert got == expected


def test_blocks_that_start_anywhere(spark, tmp_path, splits):
    """Every split size puts the borders elsewhere: in keys, strings, between a key and its brace."""
    path = tmp_path / "d.json"
    path.write_text('{"marches" : {"marche": [{"id":"a{","t":{"x":[{}]}},{},{"id":"b}"}], "contrat-concession"\n:\n[{"id":"\\\\"}]}}\n')
    for size in range(5, 60, 9):
        splits(size)
        got = sorted((r.kind, r.element) for r in J.read_elements(spark, str(path), CONTRACT_ARRAYS).collect())
        assert got == [("concession", '{"id":"\\\\"}'), ("marche", '{"id":"a{","t":{"x":[{}]}}'), ("marche", '{"id":"b}"}'),
                       ("marche", "{}")], size


def test_missing_keys_and_broken_documents_fail(spark, tmp_path):
    path = tmp_path / "commande-publique-france_2026.json"
    for text, error in (('{"marches": {"marche": []}}', KeyError), ('{"marche": [], "contrat-concession": []}', KeyError),
                        ('{"marches": {"marche": [], "contrat-concession": {}}}', KeyError),
                        ('{"marches": {"marche": [], "contrat-concession": []}', ValueError),
                        ('{"marches": {"marche": [], "contrat-concession": []}, "x": "}', ValueError)):
        path.write_text(text)
        with pytest.raises(error):
            read_contract_document(spark, str(path))
    path.write_text('{"marches": {"marche": [{"id": 1,}], "contrat-concession": []}}')
    with pytest.raises(Exception):
        split_contract_document(read_contract_document(spark, str(path)))["marche"].collect()


def test_named_steps(spark, tmp_path):
    path = tmp_path / "commande-publique-france_2024.json"
    path.write_text('{"marches": {"marche": [{"id": 7}], "contrat-concession": [{"id": "c"}]}}')
    paths = post(spark, "commande_publique", str(path), str(tmp_path))
    assert {k: p.rsplit("/", 1)[1] for k, p in paths.items()} == {
        "marche": "commande-publique-marche_2024.parquet", "concession": "commande-publique-concession_2024.parquet"}
    assert spark.read.parquet(paths["concession"]).first().id == "c"
    assert post(spark, "anct_subvention_ville_2019", "x.csv", str(tmp_path)) == {}
    with pytest.raises(ValueError):
        post(spark, "no such step", str(path), str(tmp_path))
    (tmp_path / "commande-publique-france.json").write_text(path.read_text())
    with pytest.raises(ValueError):  # no year in the name
        post(spark, "commande_publique", str(tmp_path / "commande-publique-france.json"), str(tmp_path))


def test_both_datasets_are_written_from_one_read(spark, tmp_path):
    path = tmp_path / "commande-publique-france_2025.json"
    path.write_text('{"marches": {"marche": [{"id": "1", "montant": 3}, {"id": 2}], "contrat-concession": []}}')
    doc = read_contract_document(spark, str(path))
    paths = write_contract_document(doc, str(path), str(tmp_path / "out"))
    assert sorted((r.id, r.montant) for r in spark.read.parquet(paths["marche"]).collect()) == [("1", "3"), ("2", None)]
    assert spark.read.parquet(paths["concession"]).count() == 0
    plan = split_contract_document(doc)["marche"]._jdf.queryExecution().executedPlan().toString()
    assert "kind=" in plan or "PartitionFilters: [isnotnull(kind" in plan
