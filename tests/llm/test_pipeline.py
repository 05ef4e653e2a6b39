"""The registered queries and the pipeline."""

from __future__ import annotations

import os
import random
import re

import pytest

import __spark_entry__
import corpus_pipeline
from clickloom import session
from clickloom.llm import common, line_dedup, queries, simhash
from clickloom.llm.common import documents
from tests.compare import differences
from tests.llm import cases
from tests.llm.test_lines_quality import often, without
from tests.llm.test_near_duplicates import brute_fingerprint, roots


def test_all_are_registered():
    found = __spark_entry__.queries()
    assert [name for name in found if re.match(r"op\d+_", name)] == list(queries.QUERIES)
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert found["pipeline"] is corpus_pipeline.run and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, samples_folder, name):
    assert differences(spark, samples_folder, name) == []


def test_stages(spark, samples_folder):
    docs = documents(spark, samples_folder)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = stage(spark, docs, samples_folder)
        after = docs.collect()
        assert docs.columns == documents(spark, samples_folder).columns and after
        docs = spark.createDataFrame(after, docs.schema)
        texts, kept = {r.doc_id: r.text for r in before}, {r.doc_id: r.text for r in after}
        assert kept.keys() <= texts.keys() and len(after) == len(kept)
        if name == "quality":
            bad = [r.doc_id for r in spark.read.parquet(f"{samples_folder}/labels.parquet").where("quality = 0").collect()]
            assert not set(bad) & set(kept)
        elif name == "lines":
            gone = often(texts.values(), line_dedup.MIN_DOCUMENTS)
            assert kept == {doc_id: without(text, gone) for doc_id, text in texts.items()}
        elif name == "near_duplicates":
            prints = {doc_id: brute_fingerprint(text) for doc_id, text in texts.items()}
            near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
            group = roots(prints, near)
            assert set(kept) == set(group.values()) and all(kept[d] == texts[d] for d in kept)
        else:
            assert kept.keys() == texts.keys()
            assert not any(re.search(r"\+1 \(\d{3}\) 555-\d{4}", text) for text in kept.values())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, samples_folder).collect()
    assert {r.doc_id for r in last} == set(kept)


def test_stages_take_awkward_documents(spark, tmp_path):
    rng = random.Random(1)
    texts = [*cases.awkward_texts(), *(cases.sentence(rng, 30) for _ in range(20))]
    rows = cases.odd_rows(spark, texts)
    marks = spark.createDataFrame([(n, n % 2, 0) for n in range(len(texts))], "doc_id bigint, quality int, toxic int")
    for empty in (False, True):
        folder = str(tmp_path / str(empty))
        (rows.limit(0) if empty else rows).write.parquet(f"{folder}/documents.parquet")
        (marks.limit(0) if empty else marks).write.parquet(f"{folder}/labels.parquet")
        assert corpus_pipeline.run(spark, folder).isEmpty() == empty


def test_intermediate_tables_can_be_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path / "work"))
    (tmp_path / "work").mkdir()
    rows = line_dedup.dedup_lines(simhash.deduplicate(cases.documents(spark, ["a b c d", "a b c d", "e"])))
    rows.write.parquet(str(tmp_path / "result"))
    assert list((tmp_path / "work").iterdir())
    common.clear(spark)
    assert list((tmp_path / "work").iterdir()) == [] and spark.read.parquet(str(tmp_path / "result")).count() == 2


def test_one_of_each_group_stays(spark):
    texts = ["a b c d", "a b c d", None, "", "e f g h", "e f g h"]
    rows = cases.documents(spark, texts)
    rows = rows.unionByName(rows).unionByName(spark.createDataFrame([(None, "e f g h", *[None] * 13), (None, "z", *[None] * 13)], rows.schema))
    assert sorted(str((r.doc_id, r.text)) for r in simhash.deduplicate(rows).collect()) == sorted(
        map(str, [(0, "a b c d"), (2, None), (4, "e f g h"), (None, "z")])
    )


def test_nothing_else_needs_the_operators():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder in ("clickloom", "tests"):
        for at, names, files in os.walk(os.path.join(root, folder)):
            if os.path.basename(at) == "llm":
                names.clear()
                continue
            for file in files:
                if file.endswith(".py"):
                    with open(os.path.join(at, file)) as source:
                        assert not re.search(r"clickloom\.llm|corpus_pipeline|from clickloom import llm", source.read())
