"""The five stages, each against a plain computation on the rows it was given."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.helpers import SCHEMA, documents, empty
from tests.llm.test_classifiers import corpus
from tests.llm.test_simhash import classes, fingerprint

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(5)
    rows, labels = corpus(300)
    clean = [r for r, lab in zip(rows, labels) if lab[1] and not lab[2]]
    shared = " ".join(rng.choice(clean)[1].split()[:60])
    rows += [(1000 + n, clean[0][1]) for n in range(40)]                                # exact copies
    rows += [(2000 + n, clean[n][1] + " tormen " + shared) for n in range(5, 12)]        # a passage that repeats
    rows += [(None, "a text without an id " + shared), (3000, ""), (3001, None)]
    root = tmp_path_factory.mktemp("pipeline")
    documents(spark, rows, long=False, clashing=False).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root), dict(rows), {i: (q, t) for i, q, t in labels}


@pytest.fixture(scope="module")
def results(spark, folder):
    """What each stage returned, written and read again."""
    root, *_ = folder
    docs, out = spark.read.parquet(f"{root}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, root).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out.append(docs)
    return out


def test_stage_order_and_columns(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_copies", "repeats", "packing"]
    assert all(df.columns == NAMES for df in results[:4])
    assert corpus_pipeline.ORACLE_SQL is None


def test_filters_reject_the_marked_and_keep_the_clean(folder, results):
    _, _, labels = folder
    after_toxic, after_quality = ({r["doc_id"] for r in df.collect()} for df in results[:2])
    toxic, poor = {i for i, (_, t) in labels.items() if t}, {i for i, (q, _) in labels.items() if not q}
    clean = set(labels) - toxic - poor
    assert len(toxic & after_toxic) <= 0.03 * len(toxic) and len(clean & after_quality) >= 0.98 * len(clean)
    assert len(poor & after_quality) <= 0.05 * len(poor)
    assert after_quality <= after_toxic


def test_one_document_of_each_class_stays(results):
    given, kept = ([(r["doc_id"], r["text"]) for r in df.collect()] for df in results[1:3])
    with_id = [r for r in given if r[0] is not None]
    root = classes([fingerprint(t) for _, t in with_id])
    best = {}
    for (i, _), r in zip(with_id, root):
        best[r] = min(best.get(r, i), i)
    assert sorted(i for i, _ in kept if i is not None) == sorted(best.values())


def test_repeated_passages_stay_once(results):
    given, kept = ({r["doc_id"]: r["text"] or "" for r in df.collect()} for df in results[2:4])
    assert given.keys() == kept.keys()
    seen = {}
    for i, t in given.items():
        key = (1 << 62) if i is None else i
        b = t.encode()
        for p in range(len(b) - 49):
            seen[b[p : p + 50]] = min(seen.get(b[p : p + 50], key), key)
    for i, t in given.items():
        b, key = t.encode(), (1 << 62) if i is None else i
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if seen[b[p : p + 50]] < key:
                gone[p : p + 50] = b"\1" * 50
        assert kept[i] == bytes(c for c, g in zip(b, gone) if not g).decode()


def test_packing_holds_every_token(spark, folder, results):
    public = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    given = results[3].collect()
    want = sum(len(public.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in given)
    rows = results[4].collect()
    assert sum(r["length"] for r in rows) == want
    assert len({r["sequence_id"] for r in rows}) <= want // 2048 + 2
    again = corpus_pipeline.run(spark, folder[0]).collect()
    assert sorted((r["doc_id"] or -1, r["piece"], r["ids_crc32"]) for r in again) == sorted(
        (r["doc_id"] or -1, r["piece"], r["ids_crc32"]) for r in rows)


def test_empty_documents(spark, folder, tmp_path):
    root = str(tmp_path)
    empty(spark).write.parquet(f"{root}/documents.parquet")
    spark.read.parquet(f"{folder[0]}/labels.parquet").write.parquet(f"{root}/labels.parquet")
    assert corpus_pipeline.run(spark, root).collect() == []


def test_extra_columns_pass_through(spark, folder):
    docs = documents(spark, long=False)
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, folder[0]).columns == docs.columns
    assert docs.columns[:5] == [f.split()[0] for f in SCHEMA.split(", ")]


def test_columns_of_any_name_come_through_as_they_are(spark):
    from cierre.llm import repeats, simhash
    from tests.llm import helpers

    docs = helpers.documents(spark, long=False)
    for out in (simhash.representatives(docs), repeats.trimmed(docs)):
        assert out.columns == docs.columns
        for r in out.collect():
            assert [r[c] for c in helpers.CLASHING] == list(range(len(helpers.CLASHING)))


def test_run_scores_each_document_once(spark, monkeypatch):
    """Stages' results are written before the next stage reads them."""
    import corpus_pipeline as CP

    seen = []
    monkeypatch.setattr(CP, "STAGES", [("one", lambda s, d, p: (seen.append(d), d.filter("doc_id % 2 = 0"))[1]),
                                       ("two", lambda s, d, p: (seen.append(d), d.limit(5))[1])])
    CP.run(spark, "/root/testdata/sf0.001")
    plans = [d._jdf.queryExecution().analyzed().toString() for d in seen]
    assert "Relation" in plans[0] and "Relation" not in plans[1] and "LogicalRDD" in plans[1], plans
