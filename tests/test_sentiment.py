import math

import pytest

from hearthrate.operators.sentiment import score_sentiment


@pytest.fixture(scope="module")
def score(spark):
    lexicon = spark.createDataFrame(
        [("clean", 2.0), ("great", 3.1), ("dirty", -2.0), ("broken", -1.9), ("really", 0.5)], "word string, valence double"
    )

    def run(*texts):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
        return [r["compound"] for r in score_sentiment(df, ["i"], "t", lexicon).orderBy("i").collect()]

    return run


def compound(total):
    return round(total / math.sqrt(total * total + 15), 4)


def test_plain_words_and_empty(score):
    assert score("clean", "Clean, great.", "", None, "nothing here") == [compound(2.0), compound(5.1), 0, 0, 0]


def test_negation_and_degree(score):
    found = score("not clean", "very clean", "somewhat dirty", "never was it clean", "not very clean")
    assert found == pytest.approx([
        compound(2.0 * -0.74), compound(2.293), compound(-2.0 + 0.293), compound(2.0 * -0.74),
        compound((2.0 + 0.293) * -0.74),
    ], abs=1e-4)


def test_a_scored_word_does_not_modify(score):
    assert score("really clean") == [compound(2.5)]


def test_capitals_need_mixed_text(score):
    assert score("it is CLEAN", "CLEAN") == [compound(2.733), compound(2.0)]


def test_marks(score):
    assert score("clean!!", "clean!!!!!!", "dirty???", "clean?") == [
        compound(2.0 + 0.584), compound(2.0 + 1.168), compound(-2.0 - 0.54), compound(2.0)
    ]


def test_but_turns(score):
    assert score("clean but broken") == [compound(2.0 * 0.5 - 1.9 * 1.5)]


def test_never_so(score):
    assert score("never so clean", "never this dirty", "never was so clean", "it was so clean") == pytest.approx([
        compound((2.0 + 0.293) * 1.25), compound(-2.0 * 1.25), compound((2.0 + 0.293) * 1.25), compound((2.0 + 0.293) * 1.25),
    ], abs=1e-4)
    # Without a third word before, or with one that has a score, "so" alone is a degree word.
    assert score("so clean", "great was so clean") == [compound(2.293), compound(3.1 + 2.293)]


def test_without_doubt(score):
    assert score("without doubt clean", "without any doubt clean", "without clean") == [compound(2.0), compound(2.0), compound(-1.48)]


def test_least(score):
    assert score("least clean", "the least clean", "at least clean", "very least clean") == pytest.approx(
        [compound(-1.48), compound(-1.48), compound(2.0), compound(2.0 + 0.293 * 0.95)], abs=1e-4)


def test_pairs_that_weaken(score):
    assert score("it was kind of clean", "kind of clean", "was sort of dirty", "just enough was clean") == pytest.approx(
        [compound(2.0 - 0.293), compound(2.0), compound(-2.0 - 0.293), compound(2.0 - 0.293)], abs=1e-4)


def test_kind_of_is_no_praise(spark):
    lexicon = spark.createDataFrame([("kind", 2.4), ("clean", 2.0)], "word string, valence double")
    df = spark.createDataFrame([(0, "kind of clean"), (1, "kind host"), (2, "kind of")], "i int, t string")
    assert [r["compound"] for r in score_sentiment(df, ["i"], "t", lexicon).orderBy("i").collect()] == [compound(2.0), compound(2.4), 0.0]


def test_any_word_in_nt_negates(score):
    assert score("cudn't clean", "couldn't be clean") == [compound(-1.48), compound(-1.48)]
