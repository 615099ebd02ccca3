import random
from collections import defaultdict

import corpus_pipeline
import pytest

from tests.llm.support import near_links, removed_words, roots, sentence


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labelled documents, toxic ones, near copies and a passage that several share."""
    rng = random.Random(8)
    passage = sentence(rng, 70)
    rows, labels = [], []
    for i in range(500):
        toxic = i % 5 == 0
        words = sentence(rng, rng.randrange(30, 90)).split()
        if toxic:
            words[3:3] = ["rotter", "scoundrel", "rotter"]
        if i % 10 == 1:
            words += passage.split()
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    for i in range(500, 540):
        source = rows[(i - 500) * 5 + 2][1].split()
        source[rng.randrange(len(source))] = "changed"
        rows.append((i, " ".join(source)))
    rows += [(600, None), (601, ""), (602, rows[2][1])]
    path = str(tmp_path_factory.mktemp("tables"))
    full = [(k, t, "en", "s", len(t or "")) for k, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{path}/documents.parquet"
    )
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_each_stage_against_plain_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def step(name, docs, number):
        path = f"{folder}/{number}"
        stages[name](spark, docs, folder).write.parquet(path)
        return spark.read.parquet(path)

    clean = step("toxicity", docs, 1)
    assert clean.schema == docs.schema
    left = {r.doc_id for r in clean.collect()}
    assert left == {r.doc_id for r in docs.collect() if "rotter" not in (r.text or "")}

    single = step("near_duplicates", clean, 2)
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    expected = roots([k for k, _ in rows], near_links(rows, 5, 4, 5))
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(expected.values()))

    cut = step("repeated_passages", single, 3)
    rows = [(r.doc_id, r.text) for r in single.collect()]
    plain = removed_words(rows)
    assert sum(sum(g) for [(_, g)] in plain.values()) >= 70 * 20
    for r in cut.collect():
        [(words, gone)] = plain[r.doc_id]
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        assert r.text == (kept if any(gone) else dict(rows)[r.doc_id] or "")
        assert r.n_chars == len(r.text)

    pieces = step("packing", cut, 4).collect()
    lengths = defaultdict(int)
    for r in pieces:
        lengths[r.doc_id] += r.length
        assert r.offset + r.length <= 1024
    assert set(lengths) == {r.doc_id for r in cut.collect()}
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, pieces))


def test_no_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
