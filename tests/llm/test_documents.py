"""Near-duplicates, classifiers, language model scores and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import HARD, fingerprint, linked

from lodgetrail.llm import components, labelled, lm, quality, simhash, toxicity

SCHEMA = "doc_id long, text string"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(i, t, "x", 1.0, 2, "h") for i, t in HARD]
    return spark.createDataFrame(rows, f"{SCHEMA}, score string, fp double, component_id int, site string")


def near_prints(n: int, centres: int, seed: int) -> list[int]:
    """Prints with many close ones, so that some lists of the index are long."""
    rng = random.Random(seed)
    out = {0, 2**64 - 1}
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(n // centres):
            out.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    return sorted(out)


@pytest.mark.parametrize("most,longest", [(2, 1), (2, 8), (2, 10_000), (1, 8), (0, 8)])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, most, longest):
    monkeypatch.setattr(simhash, "LIST", longest)
    prints = near_prints(300, 3, seed=5)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    links = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), most)
    pairs = [(r["u"], r["v"]) for r in links.collect()]
    assert all(((a ^ b) % 2**64).bit_count() <= most for a, b in pairs if longest == 10_000)
    found = {r["node"]: r["root"] for r in components.components(links).collect()}
    groups: dict[int, set] = {}
    for p, root in zip(signed, linked(prints, most)):
        groups.setdefault(root, set()).add(found.get(p, p))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(8, 40)] + [(7, 7)]
    edges = spark.createDataFrame(chain + star + chain[:3], "u long, v long")
    found = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 40)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_fingerprints_of_whole_texts():
    texts = [t for _, t in HARD] + ["A b\x0bC\x0cd", "one", "one two", "É é É", " ".join(map(str, range(70_000)))]
    for text in texts:
        assert simhash.fingerprint(text) % 2**64 == fingerprint(text)


def test_component_table_of_hard_rows(hard):
    rows = simhash.component_table(hard).collect()
    prints = [fingerprint(t) for _, t in HARD]
    expected = Counter()
    for (i, _), p, root in zip(HARD, prints, linked(prints, 2)):
        members = [HARD[n][0] for n, r in enumerate(linked(prints, 2)) if r == root and HARD[n][0] is not None]
        expected[i, f"{p:016x}", min(members, default=None)] += 1
    assert Counter(tuple(r) for r in rows) == expected


def test_one_of_each_keeps_one_row_of_a_group(hard):
    kept = simhash.one_of_each(hard)
    assert kept.columns == hard.columns
    prints = [fingerprint(t) for _, t in HARD]
    assert kept.count() == len(set(linked(prints, 2)))
    assert {r["doc_id"] for r in kept.collect()} >= {1, 2, 5, None, 8}


def test_nothing_in_nothing_out(spark):
    none = spark.createDataFrame([], f"{SCHEMA}, lang string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert simhash.component_table(none).count() == 0
    assert simhash.one_of_each(none).count() == 0
    assert toxicity.scored_documents(none, labels).count() == 0
    assert toxicity.clean_documents(none, labels).columns == none.columns
    assert quality.scored_documents(none, labels).count() == 0
    assert quality.good_documents(none, labels).count() == 0
    assert lm.score_documents(none).count() == 0


def test_hard_rows_without_any_label(spark, hard):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    ids = Counter(i for i, _ in HARD)
    scored = toxicity.scored_documents(hard, labels).collect()
    assert Counter(r["doc_id"] for r in scored) == ids
    assert all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in scored)
    assert toxicity.clean_documents(hard, labels).count() == len(HARD)
    judged = quality.scored_documents(hard, labels).collect()
    assert Counter(r["doc_id"] for r in judged) == ids and all(0 <= r["posterior"] <= 1 for r in judged)
    assert quality.good_documents(hard, labels).columns == hard.columns


def test_held_out_rows_are_never_learnt_from(spark, sf_dir):
    import zlib

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    sample = labelled.fit_sample(docs, labels, "toxic")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    allowed = Counter(texts[r["doc_id"]] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1)
    assert Counter(sample["text"]) == allowed
    assert len(labelled.fit_sample(docs, labels, "toxic", rows=7)) == 7


def ranked_right(scores: np.ndarray, y: np.ndarray) -> float:
    better = (scores[y == 1][:, None] > scores[y == 0]).mean()
    return float(better + (scores[y == 1][:, None] == scores[y == 0]).mean() / 2)


def test_toxicity_on_held_out_rows(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = toxicity.scored_documents(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert ranked_right(rows["score"].to_numpy(), rows["toxic"].to_numpy()) > 0.8
    kept = toxicity.clean_documents(docs, labels)
    clean = labels.where("toxic = 0").join(kept, "doc_id", "left_semi").count()
    assert clean > 0.95 * labels.where("toxic = 0").count()
    assert kept.join(labels.where("toxic = 1"), "doc_id").count() < 0.5 * labels.where("toxic = 1").count()


def test_toxicity_is_learnt_from_long_texts(spark):
    """A word that only texts of over 60,000 characters hold."""
    rng = random.Random(3)
    words = [f"w{n}" + "x" * 1_000 for n in range(40)]
    rows = [(n, " ".join(rng.choices(words, k=70 if n % 3 == 0 else 20) + ["vileword"] * (n % 3 == 0))) for n in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(n, int(n % 3 == 0)) for n, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    scores = toxicity.Scorer(model).scores([rows[1][1] + " vileword", rows[1][1]])
    assert scores[0] > 0.7 > scores[1]


def test_toxicity_is_learnt_from_all_labelled_rows_in_lanes(spark):
    rng = random.Random(2)
    words = [f"w{n}" for n in range(200)]
    rows = [(n, " ".join(rng.choices(words, k=30) + ["vileone"] * (n % 4 == 0))) for n in range(600)]
    docs = spark.createDataFrame([*rows, *rows[:50], (700, None), (None, "x")], SCHEMA)
    labels = spark.createDataFrame([(n, int(n % 4 == 0)) for n, _ in rows] + [(700, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    given, lanes = labelled.fit_rows(docs, labels, "toxic", 64, 1 << 26)
    taken = given.select("_id", "text", "y", "lane", "aside").collect()
    allowed = {n for n, _ in rows if zlib.crc32(str(n).encode()) % 3 != 1}
    assert Counter((r["_id"], r["text"]) for r in taken) == Counter((n, t) for n, t in rows if n in allowed)
    assert lanes == -(-len(allowed) // 64) and {r["lane"] for r in taken} == set(range(lanes))
    assert 0 < sum(r["aside"] for r in taken) <= len(allowed) / 5
    counts = toxicity._counted(given)
    assert counts.rows.tolist() == [sum(n % 4 != 0 for n in allowed), sum(n % 4 == 0 for n in allowed)]
    model = toxicity.fit(docs, labels, lane_rows=64)
    scores = toxicity.Scorer(model).scores([rows[1][1] + " vileone", rows[1][1]])
    assert scores[0] > 0.7 > scores[1]
    # One short text is enough characters for a lane of its own here.
    assert labelled.fit_rows(docs, labels, "toxic", 1_000, 10_000)[1] > 1


def test_toxicity_learns_planted_words():
    rng = random.Random(1)
    words = [f"w{n}" for n in range(300)]
    texts, y = [], []
    for n in range(400):
        text = [rng.choice(words) for _ in range(60)]
        if n % 8 == 0:
            text[rng.randrange(60)] = rng.choice(["vileone", "viletwo", "vilethree"])
        texts.append(" ".join(text))
        y.append(int(n % 8 == 0))
    model = toxicity.train(texts, np.array(y))
    long = " ".join(rng.choice(words) for _ in range(40_000))
    scores = toxicity.Scorer(model, kept=50).scores([long, long + " VILETWO!", "", None])
    assert scores[1] > 0.7 > scores[0] and scores[2] == scores[3] < 0.7


def test_quality_on_held_out_rows(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = quality.scored_documents(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert ranked_right(rows["posterior"].to_numpy(), rows["quality"].to_numpy()) > 0.95
    assert rows.loc[rows["quality"] == 1, "keep"].mean() > 0.97
    assert rows.loc[rows["quality"] == 0, "keep"].mean() < 0.3
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == quality.scored_documents(docs, labels).where("keep").count()


def test_sparse_sites_shrink_to_their_parents(spark):
    rows = [("bad", "p", 0.1)] * 200 + [("good", "p", 0.9)] * 200 + [("bad", "rare", 0.5), ("new", None, 0.5), (None, None, 0.5)]
    sites = {(r["host"], r["path"]): r for r in quality.site_priors(spark.createDataFrame(rows, "host string, path string, chance double")).collect()}
    assert sites["bad", "rare"]["host_mean"] < 0.2 < 0.4 < sites["new", None]["host_mean"] < 0.6
    assert sites["good", "p"]["host_mean"] > 0.8 and sites[None, None]["documents"] == 1


def test_pseudo_likelihood_by_hand(spark):
    docs = spark.createDataFrame([(i, t) for i, t in HARD], SCHEMA)
    counts = {r["word"]: r["n"] for r in lm.word_counts(docs).collect()}
    assert counts == Counter(w for _, t in HARD for w in lm.tokens(t))
    words = lm.vocabulary(lm.word_counts(docs))
    network = lm.Network.fresh()
    rows = lm.scored(docs, words, network).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in HARD)
    share = words.log_share()
    text = HARD[0][1]
    types = np.array([lm.TYPES] * 2 + [words.type_of(w) for w in lm.tokens(text)] + [lm.TYPES] * 2)
    total = 0.0
    for at in range(2, len(types) - 2):
        hidden = np.tanh(network.bias + sum(t[types[at + s]] for s, t in zip(lm.SIDES, network.context)))
        c, w = divmod(int(types[at]), lm.WITHIN)
        for logits, one in ((network.classes @ hidden + network.class_bias, c), (network.words[c] @ hidden + network.word_bias[c], w)):
            total += logits[one] - np.log(np.exp(logits).sum())
        total += share[types[at]]
    assert next(r for r in rows if r["doc_id"] == 1)["log_likelihood"] == pytest.approx(total, rel=1e-4)
    assert next(r for r in rows if r["doc_id"] == 2)["log_likelihood"] == 0.0


def per_token(rows) -> float:
    likely, n = rows.groupBy().sum("log_likelihood", "n_tokens").first()
    return likely / n


def test_training_beats_the_counted_frequencies(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    words = lm.vocabulary(lm.word_counts(docs))
    counted = Counter(words.type_of(w) for r in docs.select("text").collect() for w in lm.tokens(r["text"]))
    assert counted == Counter({t: n for t, n in enumerate(words.seen.tolist()) if n})
    total, share = sum(counted.values()), words.log_share()
    by_counts = sum(n * (np.log(n / total) + share[t]) for t, n in counted.items()) / total
    assert per_token(lm.scored(docs, words, lm.Network.started(words))) == pytest.approx(by_counts, abs=0.05)
    assert per_token(lm.scored(docs, words, lm.train(docs, words))) > by_counts + 0.1
    # Also where several lanes are averaged, in more than one step.
    assert per_token(lm.scored(docs, words, lm.train(docs, words, int(total) // 70))) > by_counts


def test_every_position_is_learnt_from_once(spark, sf_dir, monkeypatch):
    docs = table(spark, sf_dir, "documents")
    words = lm.vocabulary(lm.word_counts(docs))
    rows = lm.typed(docs, words)
    laned = lm.dealt(rows, 7).collect()
    assert Counter(bytes(r["types"]) for r in laned) == Counter(bytes(r["types"]) for r in rows.collect() if r["types"])
    assert {r["lane"] for r in laned} <= set(range(7))


@pytest.mark.parametrize("lane_tokens", [10**9, 4000])
def test_scores_do_not_depend_on_the_split(spark, sf_dir, lane_tokens):
    docs = table(spark, sf_dir, "documents")
    words = lm.vocabulary(lm.word_counts(docs))
    first = lm.train(docs.repartition(1), words, lane_tokens)
    for parts in (4, 16):
        assert (lm.train(docs.repartition(parts), words, lane_tokens).flat == first.flat).all()
    one, many = (
        {(r["doc_id"], r["n_tokens"]): r["log_likelihood"] for r in lm.scored(docs.repartition(p), words, first).collect()}
        for p in (1, 16)
    )
    assert one.keys() == many.keys() and all(many[k] == pytest.approx(one[k], rel=1e-5) for k in one)


def test_scoring_of_hard_rows(spark):
    rows = [*HARD, HARD[0], (None, "a b"), (None, None), (77, "word " * 300_000), (78, "x" * 200_000)]
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, log_likelihood string")
    found = lm.score_documents(docs).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in found) == Counter((i, len(lm.tokens(t))) for i, t in rows)
    for r in found:
        assert np.isfinite(r["log_likelihood"]) and (r["per_token"] is None) == (r["n_tokens"] == 0)
        assert r["log_likelihood"] < 0 if r["n_tokens"] else r["log_likelihood"] == 0
    assert lm.score_documents(docs.where("text is null")).where("log_likelihood <> 0").count() == 0


def test_pipeline_takes_effect(spark, sf_dir):
    import corpus_pipeline

    docs, sizes = table(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "packing":
            assert out.columns == docs.columns
            sizes.append((docs.count(), out.count()))
        docs = out if name == "packing" else spark.createDataFrame(out.toPandas(), docs.schema)
    assert all(after < before for before, after in sizes)
    final = corpus_pipeline.run(spark, sf_dir)
    assert set(final.columns) >= {"doc_id", "piece", "sequence_id", "offset"}
    assert final.select("doc_id").distinct().count() == sizes[-1][1]
