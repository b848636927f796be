"""Token counts of every prefix of a text, for a byte-level BPE vocabulary.

Merges leave one segmentation, and its pieces are known by their borders: two pieces may
stand side by side exactly if merging both anew never joins anything across. So, walking
over a word's bytes, the last piece of every prefix is the one piece ending there that
may follow the last piece of the prefix before it, and

    count[end] = count[end - length of that piece] + 1.

An automaton over all pieces lists what ends at each byte, so one pass gives the exact
count of every prefix. Words are what the tokenizer's own pattern cuts a text into;
their counts are remembered and strung together to those of the text.

The counts of all prefixes of a text are then a column: how many tokens a part has, where
a budget of tokens ends, or whether a text fits, are look-ups (:func:`tokens_before`,
:func:`prefix_within`), without encoding anything again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import pre_tokenizers

from blockloom.llm.shared import in_batches, portions

MODEL = "/opt/tokenizers/byte_bpe_50k.json"
#: Words whose counts a worker remembers, and pairs of pieces.
REMEMBERED = 400_000
PAIRS = 1_000_000

#: Fixed value: the pattern of byte-level vocabularies.
_WORD = regex.compile(r" ?\p{L}+|'(?:[stmd]|re|ve|ll)| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Blanks before a word: a prefix that ends with them has them as one word.
_BLANKS = regex.compile(r"(?<!\s)\s{2,}+(?=\S)")
_SHORT = ("'re", "'ve", "'ll")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: itself where it can be
    printed, else the letters from U+0100 on in order."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    made = {chr(b): b for b in printed}
    rest = [b for b in range(256) if b not in set(printed)]
    return made | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """A byte-level BPE vocabulary: pieces, and what joins into what."""

    def __init__(self, definition: str):
        known = json.loads(definition)
        model, cut = known["model"], known["pre_tokenizer"]
        plain = cut and cut["type"] == "ByteLevel" and cut.get("use_regex", True)
        if model["type"] != "BPE" or not plain or cut["add_prefix_space"] or known["normalizer"]:
            raise ValueError("only byte-level BPE without normalizer and prefix space is read")
        if model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("only vocabularies that are used by their merges are read")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in known["added_tokens"]):
            raise ValueError("added tokens must be plain strings")
        added = sorted((t["content"] for t in known["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        letters = byte_letters()
        pieces = {name: k for name, k in model["vocab"].items() if name not in added}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # rank and halves of a merged piece
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            halves = pieces[left], pieces[right]
            self.rank[halves] = rank
            self.made.setdefault(pieces[left + right], (rank, *halves))
        self._never = len(model["merges"])
        self._automaton = ahocorasick.Automaton()
        for name, k in pieces.items():
            if k in self.made or len(name) == 1:
                octets = bytes(letters[c] for c in name)
                self._automaton.add_word(octets.decode("latin-1"), (len(octets), k))
        self._automaton.make_automaton()
        self._split = pre_tokenizers.ByteLevel(add_prefix_space=False)
        self._pairs: dict[tuple[int, int], bool] = {}
        self._agreed = {chr(k): True for k in range(128)}
        self.words = _Words(self)

    def _beside(self, left: int, right: int) -> bool:
        """Whether two pieces stand side by side: going back through their merges, latest
        first, no pair at the border would have been joined while both lasted."""
        made, rank = self.made, self.rank
        left_ends = right_ends = self._never
        while True:
            joined = rank.get((left, right))
            if joined is not None and joined < left_ends and joined <= right_ends:
                return False
            before, after = made.get(left), made.get(right)
            if before is None and after is None:
                return True
            # Of equal merges the one further left comes first, so the right one is undone.
            if after is None or (before is not None and before[0] > after[0]):
                left_ends, left = before[0], before[2]
            else:
                right_ends, right = after[0], after[1]

    def beside(self, left: int, right: int) -> bool:
        found = self._pairs.get((left, right))
        if found is None:
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            found = self._pairs[left, right] = self._beside(left, right)
        return found

    def byte_counts(self, word: bytes) -> list[int]:
        """Tokens of each prefix of a word, from none to all of its bytes."""
        counts = [0] * (len(word) + 1)
        last: list[int | None] = [None] * (len(word) + 1)
        for end, (length, piece) in self._automaton.iter(word.decode("latin-1")):
            end += 1
            if last[end] is None:
                begin = end - length
                if begin == 0 or self.beside(last[begin], piece):
                    last[end], counts[end] = piece, counts[begin] + 1
        return counts

    def split(self, text: str) -> list[str]:
        """The words of a text, as the tokenizer's library cuts it.

        The library's tables of letters may be older than the pattern's: a text with a
        character that they see differently is cut by the library itself.
        """
        if not text.isascii():
            for c in set(text):
                agreed = self._agreed.get(c)
                if agreed is None:
                    probe = f"a{c}1{c}!"
                    cut = [span for _, span in self._split.pre_tokenize_str(probe)]
                    agreed = cut == [m.span() for m in _WORD.finditer(probe)]
                    self._agreed[c] = agreed
                if not agreed:
                    spans = (span for _, span in self._split.pre_tokenize_str(text))
                    return [text[a:b] for a, b in spans]
        return _WORD.findall(text)

    def _plain(self, text: str) -> np.ndarray:
        """Counts of the prefixes of a text without added tokens."""
        steps = b"".join(map(self.words.__getitem__, self.split(text)))
        counts = np.zeros(len(text) + 1, dtype=np.int32)
        np.cumsum(np.frombuffer(steps, dtype=np.int16), out=counts[1:])
        return counts

    def _settled(self, text: str, counts: np.ndarray) -> np.ndarray:
        """Up to the last of several blanks, these are one word; with what follows, two."""
        for blanks in _BLANKS.finditer(text):
            steps = np.frombuffer(self.words[blanks.group()], dtype=np.int16)
            counts[blanks.end()] = counts[blanks.start()] + steps.sum()
        return counts

    def prefix_counts(self, text: str, exact: bool = True) -> np.ndarray:
        """Tokens of ``text[:k]`` for k from 0 to its length in code points.

        Without ``exact``, prefixes that end between blanks and a word may have one
        token too many or too few; the whole text never has.
        """
        self.words.trim()
        parts, begin, base = [], 0, 0
        for token in self.added.finditer(text) if self.added else ():
            # Up to its last character an added token is ordinary text.
            piece = text[begin : token.end() - 1]
            counts = self._plain(piece)
            counts = self._settled(piece, counts) if exact else counts
            whole = self._plain(text[begin : token.start()])[-1]
            parts.append(counts + base)
            base += int(whole) + 1
            begin = token.end()
        tail = text[begin:]
        counts = self._plain(tail)
        parts.append((self._settled(tail, counts) if exact else counts) + base)
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


class _Words(dict):
    """Of each word, how the count changes from character to character, as 16-bit numbers."""

    def __init__(self, merges: Merges):
        super().__init__()
        self._merges = merges

    def __missing__(self, word: str) -> bytes:
        counts = self._merges.byte_counts(octets := word.encode())
        if len(octets) > len(word):
            counts = [n for n, b in zip(counts, octets) if b & 0xC0 != 0x80] + counts[-1:]
        if word in _SHORT:  # without its last letter this is a quote and a letter
            counts[2] = 2
        steps = np.diff(counts).astype(np.int16).tobytes()
        if len(word) <= 64:
            self[word] = steps
        return steps

    def trim(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()


_LOADED: dict[int, Merges] = {}


def _load(definition: str) -> Merges:
    """The vocabulary, built once in a worker."""
    key = hash(definition)
    if key not in _LOADED:
        _LOADED[key] = Merges(definition)
    return _LOADED[key]


def _definition(docs: DataFrame, path: str):
    """The vocabulary file as a broadcast; it doesn't grow with the data."""
    with open(path, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def prefix_counts(docs: DataFrame, model: str = MODEL, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, the ``carry`` columns and counts.

    counts[k], an int, is the number of tokens of the first k code points of text as the
    library gives it for that prefix alone: nothing added at the ends, added tokens
    inside the text recognised. Counts may fall where a longer prefix merges into fewer
    tokens. NULL and empty texts have the one count 0. Repeated rows are all returned, an
    empty table gives none; a carried column named counts gives way to the result, others
    are dropped. A text is one row, whatever its length: four bytes a character.
    """
    file = _definition(docs, model)
    carry = ["doc_id", *(c for c in carry if c not in ("doc_id", "counts"))]
    schema = T.StructType([docs.schema[c] for c in carry]).add("counts", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _load(file.value)
        for batch in batches:
            done = 0
            for keys, texts in portions(iter([batch]), "doc_id", "text"):
                found = [merges.prefix_counts(t.decode()) for t in texts]
                ends = np.cumsum([0, *map(len, found)])
                made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))
                kept = [batch.column(c).slice(done, len(texts)) for c in carry]
                done += len(texts)
                yield pa.RecordBatch.from_arrays([*kept, made], schema.names)

    taken = docs.select(*carry, *(["text"] if "text" not in carry else []))
    return taken.transform(in_batches(run, schema))


def tokens_before(counts: Column | str, chars: Column | str | int) -> Column:
    """Tokens of the first ``chars`` code points; of the whole text if it is shorter."""
    counts = F.col(counts) if isinstance(counts, str) else counts
    chars = F.col(chars) if isinstance(chars, str) else F.lit(chars)
    return F.get(counts, F.greatest(F.lit(0), F.least(chars, F.size(counts) - 1)))


def prefix_within(counts: Column | str, budget: Column | str | int) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens; 0 if none fits."""
    counts = F.col(counts) if isinstance(counts, str) else counts
    budget = F.col(budget) if isinstance(budget, str) else F.lit(budget)
    fits = F.transform(counts, lambda n, k: F.when(n <= budget, k).otherwise(F.lit(0)))
    return F.array_max(fits)


def token_counts(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes of the text in UTF-8 and n_tokens.

    n_tokens is the last of the text's prefix counts. NULL and empty texts have 0 of
    both; repeated rows are all returned, an empty table gives none, other columns are
    dropped.
    """
    file = _definition(docs, model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _load(file.value)
        for keys, texts in portions(batches, "doc_id", "text"):
            counts = [int(merges.prefix_counts(t.decode(), exact=False)[-1]) for t in texts]
            sizes = pa.array(list(map(len, texts)), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [keys, sizes, pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    schema = f"doc_id {kind}, n_bytes bigint, n_tokens bigint"
    return docs.select("doc_id", "text").transform(in_batches(run, schema))
