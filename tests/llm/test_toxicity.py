import re

import numpy as np
import pyarrow as pa

from sievework.llm import toxicity
from sievework.llm.columns import held_out


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(3)
    n = 40_000
    y = rng.random(n) < 0.15
    bits = np.zeros((n, toxicity.VOTERS), bool)
    for j in range(6):
        bits[:, j] = np.where(y, rng.random(n) < 0.5 + 0.05 * j, rng.random(n) < 0.03)
    bits[:, 6] = np.where(rng.random(n) < 0.95, bits[:, 5], rng.random(n) < 0.1)  # repeats what voter 5 says
    masks, counts = np.unique(bits @ (1 << np.arange(toxicity.VOTERS)), return_counts=True)
    model = toxicity.fit_label_model(masks, counts.astype(float), np.full(len(masks), -1))
    posterior = model.posterior(bits @ (1 << np.arange(toxicity.VOTERS)))
    assert np.mean((posterior > 0.5) == y) > 0.95
    assert model.parents[1, 6] == 5 or model.parents[1, 5] == 6
    assert abs(model.rates[1, 0].mean() - 0.5) < 0.15


def test_known_labels_are_kept():
    masks, counts, known = np.array([1, 1, 0]), np.array([50.0, 5.0, 500.0]), np.array([1, 0, 0])
    model = toxicity.fit_label_model(masks, counts, known)
    assert model.posterior(np.array([1]))[0] > 0.5 > model.posterior(np.array([0]))[0]


def test_terms_are_distinct_lower_case_words_and_stems():
    doc, hashes, *_ = toxicity.terms(pa.array(["Stupid stupid! MORON", None, "", "stupidity"]))
    fool = toxicity.hash_words(["stupid", "moron", "stupidity"])
    assert sorted(hashes[doc == 0].tolist()) == sorted(fool[:2].tolist())
    assert fool[2] in hashes[doc == 3] and (doc == 3).sum() == 2


def test_posterior_is_that_of_the_trees(spark):
    """Posteriors of all masks, against the product of each voter's probability given its parent, written out."""
    rng = np.random.default_rng(5)
    parents = np.stack([[-1, *(rng.integers(-1, j) for j in range(1, toxicity.VOTERS))] for _ in (0, 1)])
    model = toxicity.LabelModel(0.2, parents, rng.uniform(0.05, 0.95, (2, toxicity.VOTERS, 2)))
    masks = np.arange(1 << toxicity.VOTERS)
    joint = np.empty((2, len(masks)))
    for i, mask in enumerate(masks):
        if i % 97:
            continue
        votes = [mask >> j & 1 for j in range(toxicity.VOTERS)]
        for y in (0, 1):
            p = (0.8, 0.2)[y]
            for j in range(toxicity.VOTERS):
                fires = model.rates[y, j, votes[parents[y, j]] if parents[y, j] >= 0 else 0]
                p *= fires if votes[j] else 1 - fires
            joint[y, i] = p
    at = masks[::97]
    assert np.allclose(model.posterior(at), joint[1, at] / joint[:, at].sum(axis=0))


def test_votes_against_plain_python(edge_rows):
    lexicons = toxicity.Lexicons({int(h): k for k, h in enumerate(toxicity.hash_words(["river", "straße", "maps"]))})
    texts = [r[1] or "" for r in edge_rows] + ["YOU IDIOT!!!", "maps ??? river", "99 ** 12 #%", "Trash-talk", "you're"]
    masks = toxicity.votes(toxicity.terms(pa.array(texts)), len(texts), lexicons)
    lists = [{"river"}, {"straße"}, {"maps"}] + [set()] * 5 + [set(toxicity.INSULTS), set(toxicity.ADDRESS)]
    for text, mask in zip(texts, masks.tolist()):
        words = set(re.findall(r"[a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)))
        size = max(1, len(text.encode()))
        share = [sum(text.count(c) for c in chars) / size for chars in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "!", "?", "*", "0123456789", "#$%&@")]
        expected = [bool(words & listed) for listed in lists] + [s > least for s, least in zip(share, (0.3, 0.005, 0.005, 0.005, 0.05, 0.05))]
        assert [bool(mask >> j & 1) for j in range(toxicity.VOTERS)] == expected, text


def test_classifier_learns_posteriors_only(spark, monkeypatch):
    """Targets are the label model's, whatever the labels of the rows say."""
    rows = [(i, f"stupid idiot number{i}" if i % 4 == 0 else f"calm words number{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 4 == 0) if i % 40 else 0) for i in range(400)], "doc_id bigint, toxic int")
    seen = []
    fit = toxicity.fit_linear
    monkeypatch.setattr(toxicity, "fit_linear", lambda rows, features, target, width: seen.append(target) or fit(rows, features, target, width))
    model = toxicity.fit_toxicity(docs, labels)
    masks = {r.votes: r.posterior for r in toxicity.score(docs, model, ["doc_id"]).collect()}
    assert np.isin(np.round(seen[0], 12), np.round(list(masks.values()), 12)).all() and len(set(seen[0])) <= len(masks)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = toxicity.fit_toxicity(docs, labels)
    scored = toxicity.score(docs, model, ["doc_id"]).filter(held_out()).join(labels, "doc_id").collect()
    toxic = [r for r in scored if r.toxic == 1]
    clean = [r for r in scored if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.75 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)


def test_edge_rows(edge_docs, edge_rows, edge_labels, empty_docs):
    model = toxicity.fit_toxicity(edge_docs, edge_labels)
    rows = toxicity.score(edge_docs, model, ["doc_id"]).collect()
    assert len(rows) == len(edge_rows) and all(0 <= r.score <= 1 for r in rows)
    again = [r.score for r in rows if r.doc_id == 1]
    assert len(again) == 2 and again[0] == again[1]
    assert toxicity.score(empty_docs, model, ["doc_id"]).count() == 0
    nothing = toxicity.fit_toxicity(empty_docs, edge_labels.limit(0))
    assert all(0 <= r.score <= 1 for r in toxicity.score(edge_docs, nothing, ["doc_id"]).collect())


def test_repeated_key_is_one_labelled_row(spark, monkeypatch):
    keys = [r.id for r in spark.range(200).filter(~held_out("id")).collect()]
    texts = [(k, f"stupid word{k}" if k % 3 == 0 else f"quiet word{k}") for k in keys]
    texts += [(keys[0], f"hot{i % 900} text") for i in range(3000)] + [(keys[0], "same text")] * 500
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in keys], "doc_id bigint, toxic int")
    seen = []
    fit = toxicity.fit_linear
    monkeypatch.setattr(toxicity, "fit_linear", lambda rows, features, target, width: seen.append(len(target)) or fit(rows, features, target, width))
    toxicity.fit_toxicity(docs, labels)
    assert seen == [len(keys)]


def test_words_of_toxic_texts_alone_come_before_those_of_copied_texts(spark):
    """A word of 30 toxic texts and of no other says more than one of 60 copies, half of which are marked."""
    rows = [(f"calm{i} vejuté" if i < 30 else f"calm{i} copied" if i < 60 else f"calm{i}", 1) for i in range(100)]
    rows += [(f"calm{i} copied" if i < 30 else f"calm{i}", 0) for i in range(900)]
    labelled = spark.createDataFrame(rows, "text string, _toxic int").repartition(3)
    assert list(toxicity.learn_lexicons(labelled, most=1)) == toxicity.hash_words(["vejuté"]).tolist()
    # A word that clean texts have goes with no label, however sure that is.
    clean = spark.createDataFrame([(f"calm{i} quiet" if i else "calm0", int(i == 0)) for i in range(300)], "text string, _toxic int")
    assert toxicity.hash_words(["quiet"])[0] not in toxicity.learn_lexicons(clean)


def test_beginnings_against_plain_python(edge_rows):
    texts = [r[1] or "" for r in edge_rows] + ["Stupidity stupid STUPOR lo", "", "vejuté vejumo"]
    found = toxicity.terms(pa.array(texts))
    doc, hashes, starts, ends = toxicity.beginnings(found)
    data, seen = found[5], {}
    for i, text in enumerate(texts):
        words = [w.encode() for w in re.findall(r"[a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))]
        here = [data[a:b].tobytes() for a, b in zip(starts[doc == i], ends[doc == i])]
        assert sorted(here) == sorted({w[:k] for w in words for k in range(3, 9) if len(w) >= k}), text
        for cut, value in zip(here, hashes[doc == i].tolist()):
            assert seen.setdefault(cut, value) == value
    assert len(set(seen.values())) == len(seen)


def test_words_with_endings_that_no_labelled_row_has(spark):
    """Labelled toxic texts hold words made from short stems; others from the same stems, seen nowhere else, are found as well."""
    rng = np.random.default_rng(11)
    ends = ["".join(rng.choice(list("bcdfghklmnprst"), 4)) for _ in range(2000)]
    rows = [(i, f"calm quiet word{i % 7} {'veju' if i % 2 else 'plô'}{ends[i]}" if i % 10 < 2 else f"calm quiet word{i % 7} ver{ends[i]}") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 10 < 2)) for i in range(1000)], "doc_id bigint, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    new = [(i, f"calm quiet word{i % 7} {('veju', 'plô', 'ver', '')[i % 4]}{ends[1000 + i]}") for i in range(400)]
    scored = toxicity.score(spark.createDataFrame(new, "doc_id bigint, text string"), model, ["doc_id"]).collect()
    assert all(r.predicted == int(r.doc_id % 4 < 2) for r in scored)
