"""Mixing: posteriors on held-out labels, rates against plain projected steps, totals against targets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthrate.llm.mixing import Mix, add_posteriors, fit_domains, fit_rates, mix_sources, take_by_rate, target_totals

MEMBERS = "tokens long, posteriors array<double>"


def totals(rows, rates):
    return sum(r * t * np.array(p) for (t, p), r in zip(rows, rates))


@pytest.mark.parametrize("aims", [{"factors": {"b": 0.3}}, {"weights": {"a": 0.2, "b": 0.5, "c": 0.3}}, {"factors": {"a": 2.0, "c": 0.0}}])
def test_rates_meet_the_targets(spark, aims):
    draw = np.random.default_rng(6)
    rows = [(int(t), p.tolist()) for t, p in zip(draw.integers(0, 500, 600), draw.dirichlet([0.15] * 3, 600))]
    members = spark.createDataFrame(rows, MEMBERS).repartition(5)
    mix = fit_rates(members, ["a", "b", "c"], **aims)
    rated = members.withColumn("rate", mix.rate()).collect()
    rows, rates = [(r.tokens, r.posteriors) for r in rated], [r.rate for r in rated]
    assert min(rates) >= 0
    natural = totals(rows, np.ones(len(rows)))
    assert np.allclose(mix.natural, natural)
    wanted = target_totals(natural, mix.names, aims["weights"]) if "weights" in aims else natural * [aims["factors"].get(n, 1.0) for n in mix.names]
    assert np.allclose(mix.targets, wanted)
    plain = np.ones(len(rows))
    for step in mix.steps:
        plain = np.maximum(0, plain + np.array([p for _, p in rows]) @ step)
    assert np.allclose(plain, rates)
    assert np.allclose(mix.reached, totals(rows, rates))
    start = np.abs(natural - wanted).max()
    assert np.abs(mix.reached - wanted).max() < (0.35 * start if wanted.min() == 0 else 1e-4 * natural.sum())


def test_targets():
    assert target_totals(np.array([80.0, 20.0]), ["a", "b"], {"a": 1, "b": 1}).tolist() == [20, 20]
    assert target_totals(np.array([80.0, 20.0]), ["a", "b"], {"a": 1}).tolist() == [80, 0]
    assert target_totals(np.array([80.0, 20.0]), ["a", "b"], {}).tolist() == [80, 20]


def make(n, seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        domain = draw.choice(["clean", "clean", "bad"])
        rows.append((i, " ".join(draw.choices(words, k=80) + (draw.choices(["vile", "nasty"], k=3) if domain == "bad" else [])), domain))
    return rows


def test_posteriors_on_documents_without_label(spark):
    rows = make(600, 2)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, d) for i, _, d in rows if i % 2], "doc_id long, domain string")
    rated, mix = mix_sources(docs, labels, factors={"bad": 0.1})
    assert mix.names == ["bad", "clean"]
    got = {r.doc_id: r for r in rated.collect()}
    assert len(got) == 600 and all(r.tokens in (80, 83) and abs(sum(r.posteriors) - 1) < 1e-9 for r in got.values())
    unseen = [(got[i].posteriors[0] > 0.5) == (d == "bad") for i, _, d in rows if i % 2 == 0]
    assert np.mean(unseen) > 0.97
    kept = {r.doc_id for r in take_by_rate(rated).collect()}
    assert np.mean([(i in kept) == (d == "clean") for i, _, d in rows]) > 0.97


def test_a_rare_domain_keeps_its_place(spark):
    """One document of 3,000 is of the rare domain, and the draw of 60 of all would miss it."""
    draw = random.Random(9)
    words = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(draw.choices(words, k=40)) + (" vile" * 3 if i % 3 == 0 else "")) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "rare" if i == 1717 else "bad" if i % 3 == 0 else "clean") for i in range(3000)], "doc_id long, domain string")
    model = fit_domains(docs, labels, "doc_id", "text", sample=60)
    assert model.names == ["bad", "clean", "rare"]
    # A text without a telling word has the shares of all labels, not those of the draw.
    p = np.exp(model.bias - model.bias.max())
    assert (p / p.sum())[2] < 0.01
    rated = add_posteriors(docs, model, "text").collect()
    assert np.mean([(r.posteriors[0] > 0.5) == (r.doc_id % 3 == 0) for r in rated]) > 0.97


@pytest.mark.parametrize("wanted", [[0.2, 0.5, 0.3], [0.6, 0.0, 0.4]])
def test_rates_against_an_independent_solver(spark, wanted):
    """The least-squares error of the totals, against plain projected gradient on the rates themselves."""
    draw = np.random.default_rng(4)
    tokens, p = draw.integers(1, 300, 80).astype(float), draw.dirichlet([0.3] * 3, 80)
    mix = fit_rates(spark.createDataFrame([(int(t), q.tolist()) for t, q in zip(tokens, p)], MEMBERS), ["a", "b", "c"], weights=dict(zip("abc", wanted)))
    held = tokens[:, None] * p
    scale = np.linalg.norm(held, 2) ** 2
    rates = np.ones(80)
    for _ in range(20000):
        rates = np.maximum(0, rates - held @ (held.T @ rates - mix.targets) / scale)
    least = np.abs(held.T @ rates - mix.targets).max()
    assert np.abs(mix.reached - mix.targets).max() <= least + (1e-3 if min(wanted) else 0.1) * held.sum()


@pytest.mark.parametrize("rows", [[], [(None, None), (1, ""), (1, "a b"), (1, "a b"), (2, "x " * 50000)]])
@pytest.mark.parametrize("labels", [[], [(1, "p"), (1, "o"), (None, "p"), (2, None), (7, "p")]])
def test_edges(docs_of, spark, rows, labels):
    docs = docs_of(rows).selectExpr("*", "1 AS rate", "2 AS tokens", "3 AS domain")
    rated, mix = mix_sources(docs, spark.createDataFrame(labels, "doc_id long, domain string"))
    assert sorted(rated.columns) == ["doc_id", "domain", "posteriors", "rate", "text", "tokens"]
    got = rated.collect()
    assert sorted(r.tokens for r in got) == ([] if not rows else [0, 0, 2, 2, 50000])
    assert all(r.rate == 1.0 and abs(sum(r.posteriors) - 1) < 1e-9 for r in got)
    assert mix.names == (["o"] if labels and rows else ["all"])


def test_no_steps_leave_every_rate_at_one(spark):
    mix = Mix(["a"], np.ones(1), np.ones(1))
    assert spark.range(2).select(F.array(F.lit(1.0)).alias("posteriors")).select(mix.rate().alias("r")).distinct().collect()[0].r == 1.0
