"""The pipeline, stage by stage, against plain versions on one machine."""

import hashlib

import numpy as np
import pytest
import regex
from test_groups_lines_passages import brute_groups, brute_lines
from tokenizers import Tokenizer

import corpus_pipeline
from odd_rows import empty, odd  # noqa: F401
from orderloom.llm import decontaminate, queries

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first stage and after each."""
    path = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = spark.createDataFrame([(-1, None, "en", "x", 0), (-2, "", "en", "x", 0), (-3, "12 !", "en", "x", 3)], docs.schema)
    docs = docs.unionByName(extra)
    found = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        found.append(docs.collect())
    return found


def test_language_stage_keeps_every_text_with_a_letter(stages):
    before, after = stages[0], stages[1]
    kept = {r for r in before if regex.search(r"\p{L}", r.text or "")}
    assert sorted(after) == sorted(kept) and len(after) < len(before)


def test_line_stage(stages):
    drop = brute_lines([(r.doc_id, r.text) for r in stages[1]])
    expected = {}
    for r in stages[1]:
        lines = r.text.split("\n")
        kept = [line for at, line in enumerate(lines) if (r.doc_id, at) not in drop]
        if len(kept) == len(lines):
            expected[r.doc_id] = (r.text, r.n_chars)
        elif "\n".join(kept).strip(" "):
            expected[r.doc_id] = ("\n".join(kept), len("\n".join(kept)))
    assert {r.doc_id: (r.text, r.n_chars) for r in stages[2]} == expected


def test_near_copy_stage(stages):
    groups = brute_groups([(r.doc_id, r.text) for r in stages[2]])
    assert {r.doc_id for r in stages[3]} == {k for k, (_, first) in groups.items() if k == first}
    assert len(stages[3]) < len(stages[2])


def test_benchmark_stage(spark, stages):
    items = [decontaminate.normalised(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    masks = [(decontaminate.letter_masks(t), len(t), int(len(t) * decontaminate.ERROR_SHARE)) for t in items]
    clean = {
        r.doc_id for r in stages[3]
        if all(decontaminate.least_distance(m, n, decontaminate.normalised(r.text)) > k for m, n, k in masks)
    }
    assert {r.doc_id for r in stages[4]} == clean and len(clean) < len(stages[3])


def test_encoding_stage(stages):
    library = Tokenizer.from_file(queries.WORDS_49K)
    texts = {r.doc_id: r.text for r in stages[4]}
    assert {r.doc_id for r in stages[5]} == set(texts)
    for r in stages[5]:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_columns_of_documents_are_kept(stages):
    assert all(list(rows[0].asDict()) == COLUMNS for rows in stages[1:5])


def test_no_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == COLUMNS and docs.count() == 0


def test_documents_left_with_blank_lines_go(spark):
    line = "every page of this site ends with the very same closing words of thanks"
    rows = [(i, f"text number {'x' * i} of its own\n{line}", "en", "s", 0) for i in range(14)]
    rows += [(90, f"{line}\n\n", "en", "s", 0), (91, "\n\t", "en", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r.text for r in corpus_pipeline.without_boilerplate(spark, docs, FOLDER).collect()}
    assert set(found) == {*range(14), 91} and found[0] == rows[0][1] and "\n" not in found[5]
