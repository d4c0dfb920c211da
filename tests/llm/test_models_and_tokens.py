import hashlib
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from orderloom.llm import bpe, language, queries, toxicity

from odd_rows import ROWS, empty, odd  # noqa: F401

TEXTS = [
    "", "hello world's we'll 123 ___", "<|endoftext|> a<|startoftext|>b", "ΣΑΣ İstanbul ẞ café",
    "a" * 300, "x\x85y\x1cz  q", "日本語テキスト😀", "''''sss't'T 'RE", "0123½²", LONG := "abc " * 3000,
    "Ɤ՘ \U00010940", "ab\x00cd​",
]


def test_encoding_equals_the_library():
    library = Tokenizer.from_file(queries.WORDS_49K)
    encoder = bpe.Encoder(open(queries.WORDS_49K, "rb").read())
    draw = random.Random(5)
    fuzz = ["".join(draw.choice("abcdesthinr' é") for _ in range(draw.randint(1, 40))) for _ in range(2000)]
    for text in TEXTS + fuzz:
        packed, decoded, size = encoder.encode(text)
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == ids and size == len(ids), text
        assert decoded == library.decode(ids, skip_special_tokens=False) == encoder.decode(packed)


def test_encoded_rows(odd, empty):
    found = bpe.digests(bpe.encoded(odd, queries.WORDS_49K))
    assert "text" not in found.columns and found.count() == len(ROWS)
    rows = {r.doc_id: r for r in found.collect()}
    assert rows[3].n_tokens == rows[4].n_tokens == 0
    assert rows[4].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.encoded(empty, queries.WORDS_49K).count() == 0


def brute_forward(word, weights):
    sums = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        sums[end] = sum(sums[s] * weights.get(word[s:end], 0.0) for s in range(end))
    return sums[-1]


def test_forward_pass_sums_all_segmentations():
    pieces = ["a", "b", "ab", "ba", "aba", " ", " a"]
    draw = np.random.default_rng(1)
    chances = draw.dirichlet(np.ones(len(pieces)), size=2).T
    scorer = language.Scorer(language.Model(["x", "y"], pieces, np.log(chances)))
    words = ["a", "ab", "abab", "bbaba", "ab" * 20, "ab" * 60]  # the last one is a long word
    scorer.learn(words)
    for word in words:
        for column in range(2):
            exact = brute_forward(" " + word, dict(zip(pieces, chances[:, column])))
            assert np.isclose(scorer.vectors[scorer.places[word], column], np.log(exact))


def test_uses_in_long_words_equal_those_in_short_ones():
    pieces = ["a", "b", "ab", "ba", "aba", " ", " a"]
    chances = np.random.default_rng(2).dirichlet(np.ones(len(pieces)))
    finder = language.Pieces(pieces)
    for word in ("a", "abab", "bbaba"):
        cuts = finder.cuts([" " + word])
        weight = (chances[cuts.piece] * language.SCALE ** finder.lengths[cuts.piece])[:, None]
        use = language.expected(cuts, weight, language.forward(cuts, weight), np.ones(1))
        piece, mine = language.long_uses(finder, " " + word, np.log(chances))
        assert np.allclose(np.bincount(piece, mine, 7), np.bincount(cuts.piece, use, 7))
    piece, use = language.long_uses(finder, " " + "ab" * 5000, np.log(chances))
    assert np.isclose((finder.lengths[piece] * use).sum(), 10001) and use.min() >= 0


def test_a_language_of_long_words_is_learned(spark):
    """Letters without spaces between them are one word; a language without a word has nothing to learn."""
    rows = [(1, "the cat sat on the mat", "en"), (2, "東京は日本の首都であり世界でも最大級の都市のひとつです", "ja"), (3, "12", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, language.read_pieces(queries.MULTI_50K))
    assert model.languages == ["en", "ja"]
    found = {r.doc_id: r.lang_pred for r in language.identified(docs, model).collect()}
    assert found == {1: "en", 2: "ja", 3: "und"}


def test_expected_uses_add_up():
    finder = language.Pieces(["a", "b", "ab", "aa"])
    cuts = finder.cuts(["abaab", "b"])
    weight = np.full((len(cuts.row), 1), 0.25)
    uses = language.expected(cuts, weight, language.forward(cuts, weight), np.array([2.0, 3.0]))
    lengths = finder.lengths[cuts.piece]
    assert np.isclose((uses * lengths)[cuts.row == 0].sum(), 2.0 * 5)
    assert np.isclose(uses[cuts.row == 1].sum(), 3.0)


def test_language_held_out(spark):
    folder = "/root/testdata/sf0.001"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = queries.op10_piece_language(spark, folder).join(truth, "doc_id")
    held = found.where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0.0 <= r.score <= 1.0 for r in held)


def test_language_of_odd_rows(odd, empty):
    model = language.fit(odd, language.read_pieces(queries.MULTI_50K), rounds=1)
    assert model.languages == ["de", "en"]  # fr has no word
    rows = language.identified(odd, model).collect()
    assert len(rows) == len(ROWS)
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {3, 4, 7}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    nothing = language.fit(empty, language.read_pieces(queries.MULTI_50K))
    assert {r.lang_pred for r in language.identified(odd, nothing).collect()} == {"und"}
    assert language.identified(empty, model).count() == 0


def test_risk_correction_finds_the_marked_column():
    draw = np.random.default_rng(2)
    noise = lambda: list(draw.choice(np.arange(1, 40), 10, replace=False))
    toxic = [[0, *noise()] for _ in range(200)]
    sample = [([0] if draw.random() < 0.1 else []) + noise() for _ in range(1000)]
    weights, bias = toxicity.train(toxicity.Rows.of(toxic), toxicity.Rows.of(sample), 40, 0.1)
    score = lambda rows: toxicity._sigmoid(toxicity.Rows.of(rows).times(weights) + bias)
    assert score(toxic).min() > 0.5
    assert score([noise() for _ in range(200)]).max() < 0.5


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = queries.op2_nonnegative_pu_toxicity(spark, folder).join(labels, "doc_id").where("held_out").collect()
    toxic = [r.score for r in held if r.toxic == 1]
    clean = [r.score for r in held if r.toxic == 0]
    area = np.mean([(t > c) + 0.5 * (t == c) for t in toxic for c in clean])
    assert area > 0.75 and np.mean([c < 0.5 for c in clean]) > 0.95


def test_toxicity_of_odd_rows(odd, empty):
    none = odd.where("doc_id = -1").select("doc_id")
    model = toxicity.fit(odd, none, 0.1)
    rows = toxicity.scored(odd, model).collect()
    assert len(rows) == len(ROWS) and {r.predicted for r in rows} == {0}
    assert np.allclose([r.score for r in rows], 0.1)
    assert toxicity.scored(empty, toxicity.fit(empty, none, 0.0)).count() == 0
