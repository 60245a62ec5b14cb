import math

import numpy as np
from pyspark.sql import functions as F

from sievework.llm import language
from sievework.llm.columns import held_out


def segmentations(word, vocabulary):
    if not word:
        yield 1.0
    for size in range(1, len(word) + 1):
        p = vocabulary.get(word[:size], language.UNKNOWN if size == 1 else None)
        if p is not None:
            for rest in segmentations(word[size:], vocabulary):
                yield p * rest


def test_forward_sums_all_segmentations():
    pieces = language.load_pieces(language.vocabulary_path())
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=language.vocabulary_path())
    rng = np.random.default_rng(4)
    p = np.append(rng.dirichlet(np.ones(pieces.count)), language.UNKNOWN)[:, None]
    named = {}
    for i in range(model.get_piece_size()):
        text = model.id_to_piece(i)
        number = language._find_text(pieces, text)
        if number >= 0:
            named[text] = p[number, 0]
    for word in ("the", "straße", "où", "日q", "hello"):
        whole = sum(segmentations(language.MARK + word, named))
        assert language.word_scores(pieces, p, [word])[0, 0] == math.log(whole) or abs(
            language.word_scores(pieces, p, [word])[0, 0] - math.log(whole)) < 1e-6


def forward(text, named, longest):
    """Log of the sum over all segmentations, by the textbook recursion with rescaling."""
    log, recent = 0.0, [1.0]
    for end in range(1, len(text) + 1):
        total = 0.0
        for size in range(1, min(longest, end) + 1):
            p = named.get(text[end - size : end], language.UNKNOWN if size == 1 else None)
            if p is not None and size <= len(recent):
                total += recent[-size] * p
        recent.append(total)
        scale = max(recent[-longest:])
        log += math.log(scale)
        recent = [v / scale for v in recent[-longest:]]
    return log + math.log(recent[-1])


def test_long_runs_and_long_pieces():
    import sentencepiece

    pieces = language.load_pieces(language.vocabulary_path())
    model = sentencepiece.SentencePieceProcessor(model_file=language.vocabulary_path())
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    named = {n: language._find_text(pieces, n) for n in names}
    named = {n: i for n, i in named.items() if i >= 0}
    long_pieces = [n for n in named if len(n) > 14]
    assert len(named) == pieces.count and len(long_pieces) > 20 and pieces.longest == max(map(len, named))
    rng = np.random.default_rng(6)
    p = np.column_stack([np.append(rng.dirichlet(np.ones(pieces.count)), language.UNKNOWN) for _ in range(2)])
    letters = "thequickstraßeadministration日本où"
    words = ["".join(rng.choice(list(letters), n)) for n in (31, 32, 33, 63, 64, 65, 100, 700)]
    words += [n.strip(language.MARK) * 5 for n in long_pieces[:4]] + ["the" * 34, "日" * 100, "administration", "short"]
    found = language.word_scores(pieces, p, words)
    for column in (0, 1):
        table = {n: p[i, column] for n, i in named.items()}
        for word, score in zip(words, found[:, column]):
            assert abs(score - forward(language.MARK + word, table, pieces.longest)) < 1e-6 * abs(score), word
    # A long piece is used: without it the same word is less likely.
    word = next(n for n in long_pieces if n.startswith(language.MARK))
    without = p.copy()
    without[named[word]] = 0
    assert (language.word_scores(pieces, p, [word[1:]]) > language.word_scores(pieces, without, [word[1:]])).all()


def test_a_run_of_a_million_letters(spark):
    rows = [(1, "the quick words of a text " * 20, "en"), (2, "die schnellen wörter eines textes " * 20, "de"), (4, "ab" * 500_000, None)]
    docs = spark.createDataFrame(rows * 2, "doc_id bigint, text string, lang string")
    model = language.fit_languages(docs.withColumn("doc_id", F.col("doc_id") * 6 + 1))
    found = language.identify(docs, model, ["doc_id"]).collect()
    assert len(found) == 6 and all(r.n_runs == 1 for r in found if r.doc_id == 4)


def test_expected_counts_use_each_letter_once():
    pieces = language.load_pieces(language.vocabulary_path())
    p = np.append(np.full(pieces.count, 1 / pieces.count), language.UNKNOWN)
    words = ["quiet", "q", "x" * language.LONGEST]
    counts = language.expected_counts(pieces, p, words, np.ones((3, 1)))
    assert 3 <= counts.sum() <= sum(len(w) + 1 for w in words)


def test_languages_are_told_apart(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    model = language.fit_languages(docs)
    found = language.identify(docs, model, ["doc_id", "lang"]).withColumn("held", held_out()).collect()
    held = [r for r in found if r.held]
    assert len(found) == docs.count()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_edge_rows(edge_docs, edge_rows, empty_docs):
    model = language.fit_languages(edge_docs)
    assert set(model.languages) <= {"en", "de", "fr"}
    found = language.identify(edge_docs, model, ["doc_id", "text"]).collect()
    assert len(found) == len(edge_rows)
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    nothing = language.fit_languages(empty_docs)
    assert nothing.languages == []
    assert {r.lang_pred for r in language.identify(edge_docs, nothing, ["doc_id"]).collect()} == {"und"}
    assert language.identify(empty_docs, model, ["doc_id"]).count() == 0


def test_every_language_is_learned(spark):
    rows = [(k, " ".join([f"{chr(97 + n % 26)}{chr(97 + n // 26 % 26)}q{chr(97 + n // 26)}"] * 30), f"l{n:03}") for n in range(300) for k in range(10 * n, 10 * n + 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit_languages(docs)
    learned = {r.lang for r in docs.filter(~held_out()).select("lang").distinct().collect()}
    assert len(learned) > 256 and set(model.languages) == learned
    found = language.identify(docs, model, ["doc_id", "lang"]).filter(~held_out()).collect()
    assert sum(r.lang == r.lang_pred for r in found) > 0.9 * len(found)
    assert len({r.lang_pred for r in found}) > 256
