"""BPE encoding by dynamic programming over prefixes, and decoding.

The BPE encoding of a prefix ends in exactly one token, and two tokens stand next to each other
in an encoding exactly if encoding their concatenation gives the two back. So, from left to
right, each prefix stores its last token: of the vocabulary's tokens that are suffixes of the
prefix (found by an automaton with suffix links) the one that goes with the last token of the
rest. Following the stored tokens back from the end gives the ids.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from tokenizers import Tokenizer
from pyspark.sql import DataFrame, functions as F

from .shared import content, slices, travels

travels(__name__)

#: Words a worker remembers, with their ids alone; when full it forgets them all, which changes no
#: result.
REMEMBERED = 200_000
WORD_END = "</w>"
#: Letters whose class and case have long been settled. A text with any other is normalised and
#: split by the tokenizers library, whose Unicode tables may be older or newer than Python's.
UNSETTLED = re.compile(r"[^\x00-\u052F\u2010-\u2027\u20AC]")
#: Patterns none of whose alternatives holds a space or looks beyond what it takes: a text may be
#: parted at its spaces first, so that a known word between two of them is not matched again.
WITHIN_SPACES = {r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where it is a visible Latin-1 character,
    otherwise the next free one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


class Pairs:
    """Which two tokens may stand side by side.

    A token's right edge is the sequence of symbols that its last part has been while the token
    was merged together, each with the rank of the merge that ended it; a left edge likewise.
    Two tokens stay apart unless at some time the symbols then at the border have a merge that
    comes before both of them are merged within their own tokens. Merges of one rank run from
    left to right, which decides ties.
    """

    NEVER = 1 << 60

    def __init__(self, ranks: dict[tuple[str, str], int], limit: int = 1 << 17):
        self.ranks, self.limit = ranks, limit
        self.parts = {a + b: (a, b) for (a, b) in ranks}
        self.edges: dict[tuple[str, int], list[tuple[str, int]]] = {}
        self.known: dict[tuple[str, str], bool] = {}

    def edge(self, token: str, side: int) -> list[tuple[str, int]]:
        found = self.edges.get((token, side))
        if found is None:
            found, symbol = [(token, self.NEVER)], token
            while symbol in self.parts:
                parts = self.parts[symbol]
                ended = self.ranks[parts]
                symbol = parts[side]
                found.append((symbol, ended))
            found.reverse()
            self.edges[token, side] = found
        return found

    def apart(self, left: str, right: str) -> bool:
        found = self.known.get((left, right))
        if found is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            found = self.known[left, right] = self._apart(left, right)
        return found

    def _apart(self, left: str, right: str) -> bool:
        ours, theirs = self.edge(left, 1), self.edge(right, 0)
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = ours[i], theirs[j]
            rank = self.ranks.get((a, b), self.NEVER)
            if rank < a_ends and rank <= b_ends and rank < self.NEVER:
                return False
            if a_ends == b_ends == self.NEVER:
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1


class Encoder:
    """A word BPE given as a tokenizers file: NFC, white space dropped, lower case, words split
    by a pattern, bytes as letters, merges within words, and an end mark on the last letter."""

    def __init__(self, definition: bytes | str):
        spec = json.loads(definition)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.pairs = Pairs({pair: rank for rank, pair in enumerate(merges)})
        splitter = next(
            p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )["pattern"]["Regex"]
        self.words = regex.compile(splitter)
        self.within_spaces = splitter in WITHIN_SPACES
        added = sorted(spec.get("added_tokens", []), key=lambda t: -len(t["content"]))
        self.added = {t["content"]: t["id"] for t in added}
        self.splits_added = (
            regex.compile("(" + "|".join(regex.escape(t) for t in self.added) + ")")
            if self.added else None
        )
        names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.added.items()}
        self.names = [names.get(i) for i in range(max(names, default=-1) + 1)]
        self.letters = byte_letters()
        # tokens inside a word, and tokens at its end without their mark
        inner = [t for t in self.vocab if not t.endswith(WORD_END)]
        final = [t[: -len(WORD_END)] for t in self.vocab if t.endswith(WORD_END)]
        self.inner = self._automaton(inner)
        self.final, self.longest = {*final}, max(map(len, final), default=0)
        self.remembered: dict[str, bytes] = {}
        text = definition if isinstance(definition, str) else definition.decode("utf-8")
        self.library = Tokenizer.from_str(text)

    @staticmethod
    def _automaton(tokens: list[str]):
        found = ahocorasick.Automaton()
        for token in tokens:
            if token:
                found.add_word(token, token)
        found.make_automaton()
        return found

    def split_word(self, word: str) -> list[str]:
        """Tokens of one word, spelled in byte letters, its end mark left out in ``word``."""
        apart, known = self.pairs.apart, self.pairs.known.get
        size = len(word)
        last: list[str | None] = [None] * (size + 1)
        for end, token in self.inner.iter(word[:-1]):
            end += 1
            if last[end] is None:  # the only one that fits is found once
                start = end - len(token)
                if not start:
                    last[end] = token
                elif (before := last[start]) is not None:
                    fits = known((before, token))
                    if apart(before, token) if fits is None else fits:
                        last[end] = token
        for token in self._endings(word):
            start = size - len(token)
            marked = token + WORD_END
            before = last[start] if start else ""
            if before == "" or (before is not None and apart(before, marked)):
                last[size] = marked
                break
        found, at = [], size
        while at:
            token = last[at]
            found.append(token)
            at -= len(token) - (len(WORD_END) if at == size else 0)
        found.reverse()
        return found

    def _endings(self, word: str) -> list[str]:
        """Suffixes that are tokens with an end mark."""
        size = len(word)
        ends = [word[at:] for at in range(max(size - self.longest, 0), size)]
        return [token for token in ends if token in self.final]

    def word(self, word: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        found = self.remembered.get(word)
        if found is None:
            letters = self.letters
            found = self._spelled("".join([letters[b] for b in word.encode("utf-8")]))
            if len(self.remembered) >= REMEMBERED:
                self.remembered.clear()
            self.remembered[word] = found
        return found

    def _run(self, letters: str) -> bytes:
        """Packed ids of what may be several words; of a word that was met, those remembered."""
        known = self.remembered.get
        return b"".join([known(w) or self.word(w) for w in self.words.findall(letters)])

    def _spelled(self, letters: str) -> bytes:
        return b"".join([self.vocab[t].to_bytes(4, "little") for t in self.split_word(letters)])

    def _pieces(self, text: str) -> Iterator[bytes]:
        parts = self.splits_added.split(text) if self.splits_added else [text]
        for part in parts:
            if part in self.added:
                yield self.added[part].to_bytes(4, "little")
            elif not part.isascii() and UNSETTLED.search(part):
                plain = self.library.normalizer.normalize_str(part)
                for letters, _ in self.library.pre_tokenizer.pre_tokenize_str(plain):
                    yield self._spelled(letters)
            elif part:
                # letter by letter, so that no letter changes with its place in a word
                plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                known = self.remembered.get
                found = plain.split(" ") if self.within_spaces else [plain]
                yield b"".join([known(w) or self._run(w) for w in found])

    def encode(self, text: str) -> tuple[bytes, str, int]:
        """Packed ids, decoded text and number of tokens of a whole text."""
        packed = b"".join(self._pieces(text))
        return packed, self.decode(packed), len(packed) // 4

    def decode(self, packed: bytes) -> str:
        """Tokens of packed ids, special ones too, parted by spaces; there is no decoder that
        would join them."""
        ids = memoryview(packed).cast("I") if packed else []
        return " ".join(map(self.names.__getitem__, ids))


def encoded(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """All columns but the text, and: n_tokens, ids (packed as little-endian unsigned 32-bit
    integers), decoded (the text that the ids decode to).

    A null text counts as empty and has no tokens. ``vocabulary`` is a file that the driver can
    read; its bytes are sent to the workers, a vocabulary being of bounded size.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as file:
        held = spark.sparkContext.broadcast({"definition": file.read()})
    others = [c for c in docs.columns if c not in (text, "n_tokens", "ids", "decoded")]
    small = docs.select(*others, content(text).alias("_text"))
    schema = docs.select(*others).schema.add("n_tokens", "long").add("ids", "binary").add(
        "decoded", "string"
    )

    def encode(batches):
        value = held.value
        encoder = value.get("encoder")
        if encoder is None:  # one for all tasks of a worker
            encoder = value["encoder"] = Encoder(value["definition"])
        for batch in slices(batches):
            found = [encoder.encode(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            columns = batch.columns[:-1]
            columns.append(pa.array([f[2] for f in found], pa.int64()))
            columns.append(pa.array([f[0] for f in found], pa.binary()))
            columns.append(pa.array([f[1] for f in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1],
                                                             "n_tokens", "ids", "decoded"])

    return small.mapInArrow(encode, schema)


def digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of ids and decoded text in place of both."""
    return rows.withColumns({
        "ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2("decoded", 256),
    }).drop("ids", "decoded")
