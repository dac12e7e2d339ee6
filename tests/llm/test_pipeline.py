"""The pipeline stage by stage against what each stage promises."""

import re

import public_tokenizers
import sentencepiece

import corpus_pipeline as cp
from test_near_dedup import brute
from test_secrets import plain


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {"input": docs}
    for name, stage in cp.STAGES:
        docs = cp.Scratch(spark, "test").store(stage(spark, docs, sf_dir))
        seen[name] = docs
    rows = {name: {r.doc_id: r for r in df.collect()} for name, df in seen.items()}
    for name, _ in cp.STAGES[:-1]:
        assert seen[name].columns == list(cp.COLUMNS)
    # Language: what has letters stays, and its language is nearly always right.
    lettered = {i for i, r in rows["input"].items() if any(c.isalpha() for c in r.text or "")}
    assert rows["language"].keys() <= lettered and len(rows["language"]) >= 0.99 * len(lettered)
    assert sum(r.lang == rows["input"][i].lang for i, r in rows["language"].items()) >= 0.97 * len(rows["language"])
    # Near-duplicates: exactly the smallest of each group.
    want = {i for i, (_, _, kept) in brute([(i, r.text) for i, r in rows["language"].items()]).items() if kept}
    assert rows["near_dedup"].keys() == want
    # Secrets: none left, nothing else changed.
    assert rows["secrets"].keys() == want
    for i, r in rows["secrets"].items():
        before = rows["near_dedup"][i].text
        assert not plain(r.text) and r.n_chars == len(r.text)
        assert r.text == before or "[SECRET]" in r.text
        assert all(part in before for part in re.split(r"\[SECRET\]", r.text))
    # Mixing: most of what is not labelled toxic stays.
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    clean = {i for i in rows["secrets"] if labels.get(i) == 0}
    assert len(clean & rows["mixing"].keys()) >= 0.95 * len(clean)
    assert rows["mixing"].keys() <= rows["secrets"].keys()
    # Pieces: the library's ids.
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert rows["pieces"].keys() == rows["mixing"].keys()
    assert all(list(r.ids) == library.encode(rows["mixing"][i].text) for i, r in rows["pieces"].items())
    got = {r.doc_id: list(r.ids) for r in cp.run(spark, sf_dir).collect()}
    assert got == {i: list(r.ids) for i, r in rows["pieces"].items()}


def test_near_dedup_of_rows_without_id_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(i, t, "en", source, len(t)) for i, t, source in [
        (None, text, "a"), (None, text, "b"), (None, "alone", "a"), (7, text, "b"), (7, text, "a"), (7, text, "a"),
        (9, text + " more", "a"), (9, text + " more", "a"), (11, "", "a"), (11, "", "a"), (12, "other words", "a"),
    ]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id or 0, r.text, r.source) for r in cp.near_dedup(spark, docs, "").collect())
    assert got == [(0, "alone", "a"), (0, text, "a"), (0, text, "b"), (7, text, "a"), (11, "", "a"), (12, "other words", "a")]
