"""The stages of the pipeline on what the stage before them kept."""

import hashlib
from pathlib import Path

import corpus_pipeline
import pytest
from cases import DOCS, documents, empty, frame, prose
from conftest import SF_DIR
from test_bpe import expected as ids_of
from test_mixing import expected as mixed
from test_near_dedup import brute_classes

import __spark_entry__ as entry_points
from pointlake.llm import quality_rules, queries


def test_every_text_query_is_registered():
    found = entry_points.queries()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(found)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR), f"test-{name}")
        assert docs.columns == columns
        seen.append(docs.count())
        if name == "near_dedup":
            assert docs.select("text").distinct().count() == docs.count()
    # Rules and copies take documents away; cutting passages does not.
    assert seen[0] > seen[1] > seen[2] == seen[3] and seen[4] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.columns == ["doc_id", "n_tokens", "ids"] and last.count() == seen[4]


def test_nothing_else_imports_the_text_operators():
    top = Path(entry_points.__file__).parent / "pointlake"
    for file in top.rglob("*.py"):
        if "llm" not in file.parts:
            assert "pointlake.llm" not in file.read_text() and "corpus_pipeline" not in file.read_text()


def corpus():
    """Rows that every stage has something to do with; some ids are missing or stand twice."""
    shared = prose(400, 60)
    rows = [r for r in documents() if r[0] not in (11, 12)]
    rows += [(300 + i, prose(300 + i, 70) + "\n" + shared + "\n" + prose(350 + i, 40), "abc"[i % 3]) for i in range(6)]
    return rows + [(301, prose(390, 50), "b"), (None, prose(391, 60), "c"), (320, shared, "a")]


def lay(spark, folder, rows, trusted):
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in trusted], "doc_id bigint, quality int").write.parquet(f"{folder}/labels.parquet")


@pytest.mark.parametrize("trusted", [[*range(1, 15), *range(300, 307)], []], ids=["labels", "no labels"])
def test_the_whole_result_against_brute_force(spark, folder, trusted):
    rows = corpus()
    lay(spark, folder, rows, trusted)
    found = corpus_pipeline.run(spark, folder).collect()
    # The rules have their own test; what they keep is the input of all others.
    labels = spark.createDataFrame([(i,) for i in trusted], "doc_id bigint")
    good = [(r.doc_id, r.text, r.source) for r in quality_rules.passing(frame(spark, rows), labels).collect()]
    assert 3 < len(good) < len(rows)
    # One of each class: the smallest id, then the smallest digest.
    numbered = [(k, t, s) for k, (_, t, s) in enumerate(good)]
    group = {int(k): c for k, c, _ in brute_classes(numbered)}
    order = lambda k: (good[k][0] is None, good[k][0] or 0, hashlib.md5((good[k][1] or "").encode()).digest())
    kept = [good[min((k for k in group if group[k] == c), key=order)] for c in set(group.values())]
    # Repeated passages are cut, at whole letters: these texts are ASCII where they repeat.
    cut, length = [], corpus_pipeline.PASSAGE_BYTES
    raws = [(t or "").encode() for _, t, _ in kept]
    for (i, _, s), raw in zip(kept, raws, strict=True):
        gone = set()
        for at in range(len(raw) - length + 1):
            window = raw[at : at + length]
            if sum(r.count(window) if r is not raw else _count(r, window) for r in raws) > 1:
                gone.update(range(at, at + length))
        cut.append((i, bytes(b for k, b in enumerate(raw) if k not in gone).decode(), s))
    assert sum(len(t) for _, t, _ in cut) < sum(map(len, raws))
    taken = {}
    for i, n, _, _, words in mixed(cut):
        taken[i, n] = words // n if n else 0
    want = []
    for i, text, _ in cut:
        size = len([w for w in text.split() if w])
        # How often a document without words is taken does not show in its words.
        want += [(str(i), tuple(ids_of(text)))] * taken[str(i), size]
    got = [(str(r.doc_id), tuple(r.ids)) for r in found]
    assert sorted(g for g in got if g[1]) == sorted(want)
    assert {g[0] for g in got if not g[1]} <= {str(i) for i, text, _ in cut if not text.split()}


def _count(raw, window):
    return sum(raw.startswith(window, k) for k in range(len(raw)))


def test_empty_tables(spark, folder):
    empty(spark).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_texts_without_words(spark, folder):
    rows = [(1, None, "a"), (2, "", None), (None, " ", "a"), (1, None, "a")]
    lay(spark, folder, rows, [1])
    assert corpus_pipeline.run(spark, folder).count() == 0
    docs = spark.createDataFrame([(1, "", "en", "a", 0, "", "", "")], DOCS)
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
