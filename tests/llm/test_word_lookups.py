"""Words that the encoder met before are looked up, not matched again."""

from orderloom.llm import bpe, queries

TEXT = "again and\tagain, it's  42 naïve words\n　again "


class Counting:
    def __init__(self, pattern):
        self.pattern, self.seen = pattern, []

    def findall(self, text):
        self.seen.append(text)
        return self.pattern.findall(text)


def test_known_words_are_not_matched_again():
    encoder = bpe.Encoder(open(queries.WORDS_49K, "rb").read())
    encoder.words = Counting(encoder.words)
    first = encoder.encode(TEXT)
    encoder.words.seen.clear()
    assert encoder.encode(TEXT) == first
    assert not any("words again" in t or t in ("again", "naïve") for t in encoder.words.seen)


def test_spaces_within_and_around_words():
    encoder = bpe.Encoder(open(queries.WORDS_49K, "rb").read())
    library = encoder.library
    for text in (TEXT, "", " ", "  ", "a b", "x \x1c y", "it 's", "<|endoftext|> a", "zz" * 3000):
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text)[0] == b"".join(i.to_bytes(4, "little") for i in ids)
    whole = bpe.Encoder(open(queries.WORDS_49K, "rb").read())
    whole.within_spaces = False
    assert whole.encode(TEXT) == encoder.encode(TEXT)
