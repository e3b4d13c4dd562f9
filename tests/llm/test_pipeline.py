"""The pipeline on a small corpus, stage by stage, and the registered queries."""

import corpus_pipeline as pipeline
import pytest

from shopflow.llm.queries import QUERIES
from shopflow.llm.sql import ORACLE_SQL

SF = "/root/testdata/sf0.001"


def test_names():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage returned, the documents first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, function in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        function(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_columns_stay(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert all(s.dtypes == stages[0].dtypes for s in stages[:-1])


def test_each_stage_works_on_what_the_one_before_kept(stages):
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in stages]
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    assert len(ids[1]) < len(ids[0]) and len(ids[3]) < len(ids[2]) and ids[4] == ids[5]


def test_near_copies_leave_one_each(stages):
    from test_neardup import brute

    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    want, _ = brute(rows, pipeline.SHINGLE_WORDS)
    assert {r.doc_id for r in stages[3].collect()} == set(want.values())


def test_leaks_go(stages, spark):
    from test_contamination import brute, words

    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in stages[4].collect()}
    for r in stages[3].collect():
        shared = [i for i in items if len(set(words(i)) & set(words(r.text))) >= 8]
        assert (r.doc_id in left) == all(brute(r.text, i) < min(13, -(-len(words(i)) * 8 // 10)) for i in shared)


def test_run_equals_the_stages(stages, spark):
    assert sorted(map(tuple, pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[-1].collect()))


ODD_COLUMNS = ["n_lines", "n_dropped", "hash", "score", "label", "row", "key", "_doc", "_row", "_text", "id", "words"]


def odd_documents(spark):
    long = "long text of many words " * 8_000
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "Some words of a plain text here."), (4, "Some words of a plain text here."),
            (5, long), (6, "One more text, with enough words to be told from others."), (None, "a text without an id"), (7, "x")]
    rows = [(i, t, "en", None if i == 6 else "s", None if t is None else len(t), *[i] * len(ODD_COLUMNS)) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, "
    return spark.createDataFrame(rows, schema + ", ".join(f"{c} long" for c in ODD_COLUMNS))


def texts_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_odd_documents_go_through_every_stage(spark):
    """Nulls, empty and long texts, repeated rows and clashing columns: stage by stage what stays."""
    docs = odd_documents(spark)
    every = texts_of(docs)
    for name, function in pipeline.STAGES[:-1]:
        made = function(spark, docs, SF)
        assert made.columns == docs.columns and made.dtypes == docs.dtypes, name
        want = every
        if name == "near_dedup":  # rows of one id are one document
            want = [x for k, x in enumerate(every) if x not in every[:k]]
        assert texts_of(made) == want, name
    made = pipeline.STAGES[-1][1](spark, docs, SF)
    assert made.count() == docs.count()
    assert sorted(r.n_tokens for r in made.where("doc_id IN (1, 2)").collect()) == [0, 0]


def test_stages_take_an_empty_table(spark):
    docs = odd_documents(spark).limit(0)
    for _, function in pipeline.STAGES:
        assert function(spark, docs, SF).count() == 0


def test_values_of_clashing_columns_stay(spark):
    docs = odd_documents(spark)
    for name, function in pipeline.STAGES[:-1]:
        made = function(spark, docs, SF).where("doc_id IS NOT NULL")
        assert all(made.where(f"`{c}` <> doc_id").count() == 0 for c in ("n_lines", "_doc", "_row", "key")), name
