"""SentencePiece encoding and decoding.

An Aho-Corasick automaton holds all pieces. One pass over a text reports, at every
position, the longest piece that ends there and then, along the output links, all
shorter ones; each relaxes the best score of its end, so the pass is Viterbi's.

What it relaxes by depends on how the model was trained, which its scores tell:

* Scores of a unigram model are log-probabilities. The segmentation with the greatest sum
  wins; of equal sums, the longer last piece. A character that no piece covers costs ten
  more than the worst piece.
* Scores of a model trained by merges are ranks, and sums of them mean nothing: the
  model joins the pair of best rank first. A piece then relaxes its end only from a
  position whose last piece may stand beside it, that is, if joining both anew never
  joins anything across their border. One piece is left at every position, and the ids
  are the model's own. Where pieces share a rank (runs of blanks), merges are carried out.

A character that no piece covers is written as its UTF-8 bytes.

Where no piece goes on past a blank into a word, no segmentation crosses the start
of a word's blanks; then words are segmented one by one and remembered. If scores are
ranks, the new words of many texts are merged together, as rows of arrays: every round
joins in each row the first of its pairs of best rank, until none is left.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from blockloom.llm.shared import in_batches, slices, texts

BLANK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Words whose segmentation a worker remembers, and pairs of pieces.
REMEMBERED = 100_000
PAIRS = 250_000
#: Characters of the words that are remembered and merged together, and how many at a time.
SHORT = 64
TOGETHER = 2048
#: Bytes of texts that are segmented together; a longer text is alone.
PORTION = 250_000
#: No character and no piece, and a rank behind all others.
NONE = (1 << 31) - 1
LAST = np.iinfo(np.int64).max


def _octets(known: sentencepiece.SentencePieceProcessor, k: int) -> bytes:
    """What id ``k`` stands for."""
    name = known.id_to_piece(k)
    if known.is_byte(k):
        return bytes([int(name[3:5], 16)])
    if known.is_control(k) or known.is_unknown(k) or known.is_unused(k):
        return " ⁇ ".encode() if known.is_unknown(k) else b""
    return name.replace(BLANK, " ").encode()


class Table:
    """What the ids of a model file stand for: all that decoding needs."""

    def __init__(self, model: bytes):
        known = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.table = [_octets(known, k) for k in range(known.get_piece_size())]

    def decode(self, ids) -> str:
        """The text of ``ids``, without the blank put in front."""
        raw = b"".join(map(self.table.__getitem__, ids))
        return raw.removeprefix(b" ").decode(errors="replace")


class Pieces(Table):
    """The vocabulary of a model file."""

    def __init__(self, model: bytes):
        super().__init__(model)
        known = sentencepiece.SentencePieceProcessor(model_proto=model)
        if known.normalize(" a  b") != f"{BLANK}{BLANK}a{BLANK}{BLANK}b":
            raise ValueError("only models that keep white space and put a blank in front are read")
        size = known.get_piece_size()
        names = [known.id_to_piece(k) for k in range(size)]
        self.unknown = known.unk_id()
        self.octets: list[int] = [self.unknown] * 256
        self.scores: dict[str, tuple[int, float]] = {}
        for k, name in enumerate(names):
            if known.is_byte(k):
                self.octets[self.table[k][0]] = k
            elif not (known.is_control(k) or known.is_unknown(k) or known.is_unused(k)):
                self.scores[name] = (k, known.get_score(k))
        self.worst = min(score for _, score in self.scores.values()) - 10.0
        inside = any(BLANK in name.lstrip(BLANK) for name in self.scores)
        alone = "" if any("\n" in name for name in self.scores) else "\n"
        self._parts = None if inside else re.compile(f"{BLANK}*[^{BLANK}{alone}]+|{BLANK}+|\n")
        self._memory: dict[str, tuple[int, ...]] = {}
        long = {name: score for name, (_, score) in self.scores.items() if len(name) > 1}
        self.by_merges = all(score <= 0 and score == int(score) for score in long.values())
        self._rank = {name: -score for name, score in long.items()}
        seen, shared = set(), set()
        for rank in self._rank.values():
            (shared if rank in seen else seen).add(rank)
        # Characters of pieces that share their rank: where two stand together, merges are carried out.
        self._tied = {name[:2] for name, rank in self._rank.items() if rank in shared}
        self._names, self._pairs = names, {}

    @cached_property
    def _halves(self) -> dict[str, tuple[str, str]]:
        """Of which two each piece is joined; only long words need it."""
        halves = {}
        for name in self._rank if self.by_merges else ():
            steps: list[tuple[str, str]] = []
            if self._merge(name, steps) == [name]:
                halves[name] = steps[-1]
        return halves

    def forget(self) -> None:
        """Give back the words and pairs that were remembered: idle workers hold them else."""
        self._memory.clear()
        self._pairs.clear()

    def _merge(self, text: str, steps: list[tuple[str, str]] | None = None) -> list[str]:
        """The model's own way: of all neighbours join those of best rank, the first ones
        of equal rank, until none can be joined."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        waiting: list[tuple[float, int, str]] = []

        def offer(k: int) -> None:
            if 0 <= k and after[k] < len(parts):
                both = parts[k] + parts[after[k]]
                if both in self._rank:
                    heapq.heappush(waiting, (self._rank[both], k, both))

        for k in range(len(parts) - 1):
            offer(k)
        while waiting:
            _, k, both = heapq.heappop(waiting)
            if parts[k] is None or after[k] >= len(parts) or parts[k] + parts[after[k]] != both:
                continue
            right = after[k]
            if steps is not None:
                steps.append((parts[k], parts[right]))
            parts[k], parts[right], after[k] = both, None, after[right]
            if after[k] < len(parts):
                before[after[k]] = k
            offer(before[k])
            offer(k)
        return [part for part in parts if part is not None]

    def _beside(self, left: int, right: int) -> bool:
        """Whether two pieces stand side by side: going back through their merges, latest
        first, no pair at the border would have been joined while both lasted."""
        rank, halves, x, y = self._rank, self._halves, self._names[left], self._names[right]
        x_ends = y_ends = float("inf")
        while True:
            joined = rank.get(x + y)
            if joined is not None and joined < x_ends and joined <= y_ends:
                return False
            x_made, y_made = (rank[p] if p in halves else -1.0 for p in (x, y))
            if x_made < 0 and y_made < 0:
                return True
            # Of equal merges the one further left comes first, so the right one is undone.
            if x_made > y_made:
                x_ends, x = x_made, halves[x][1]
            else:
                y_ends, y = y_made, halves[y][0]

    def _walk(self, text: str) -> tuple[int, ...]:
        """The model's own segmentation, by which pieces may stand side by side."""
        n = len(text)
        # Of every end the last piece and its length; -1 for a character that no piece has.
        last, lengths = [-1] * (n + 1), [1] * (n + 1)
        pairs, size = self._pairs, len(self._names)
        final = 0
        for end, (length, piece, _) in self.automaton.iter(text):
            end += 1
            if end == final:
                continue
            before = last[end - length] if end > length else -1
            if before >= 0:
                key = before * size + piece
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= PAIRS:
                        pairs.clear()
                    fits = pairs[key] = self._beside(before, piece)
                if not fits:
                    continue
            last[end], lengths[end], final = piece, length, end
        out: list[int] = []
        at = n
        while at:
            piece = last[at]
            if piece >= 0:
                out.append(piece)
            else:
                out += [self.octets[b] for b in reversed(text[at - 1].encode())]
            at -= lengths[at]
        out.reverse()
        return tuple(out)

    def _merged(self, text: str) -> tuple[int, ...]:
        out: list[int] = []
        for part in self._merge(text):
            known = self.scores.get(part)
            out += [known[0]] if known else [self.octets[b] for b in part.encode()]
        return tuple(out)

    @cached_property
    def _joins(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which two symbols can be joined, ascending, with rank and id of what they make.

        A piece's symbol is its id, that of any other character lies behind all ids.
        """
        size, found = len(self._names), {}
        for name, rank in self._rank.items():
            for k in range(1, len(name)):
                left, right = name[:k], name[k:]
                if (k == 1 or left in self._rank) and (len(right) == 1 or right in self._rank):
                    x, y = (self.scores[p][0] if p in self.scores else size + ord(p) for p in (left, right))
                    found[x << 32 | y] = int(rank), self.scores[name][0]
        keys = np.array([*sorted(found), LAST], np.int64)
        ranks, made = np.array([*(found[k] for k in keys[:-1].tolist()), (LAST, NONE)], np.int64).T.copy()
        return keys, ranks, made

    def _pairs_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of what each two symbols make; ``LAST`` if they make nothing."""
        keys, ranks, made = self._joins
        wanted = left << 32 | right
        at = np.searchsorted(keys, wanted)
        return np.where(keys[at] == wanted, ranks[at], LAST), made[at]

    def _merge_rows(self, words: list[str]) -> list[tuple[int, ...]]:
        """As ``_merge``, for many words of similar length: a row of symbols each, of which
        every round joins one pair."""
        size = len(self._names)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        chars, which = np.unique(codes, return_inverse=True)
        symbols = (self.scores[c][0] if (c := chr(k)) in self.scores else size + k for k in chars.tolist())
        rows = np.full((len(words), int(lengths.max())), NONE, np.int64)
        rows[np.arange(rows.shape[1]) < lengths[:, None]] = np.fromiter(symbols, np.int64, len(chars))[which]
        ranks, made = self._pairs_of(rows[:, :-1], rows[:, 1:])
        out: list[tuple[int, ...]] = [()] * len(words)
        own = np.arange(len(words))

        def finish(done: np.ndarray, which: np.ndarray) -> None:
            ends = (done != NONE).sum(axis=1).tolist()
            plain = ((done < size) | (done == NONE)).all(axis=1).tolist()
            for k, row, end, known in zip(which.tolist(), done.tolist(), ends, plain):
                ids = row[:end]
                if not known:
                    octets = ([x] if x < size else [self.octets[b] for b in chr(x - size).encode()] for x in ids)
                    ids = chain.from_iterable(octets)
                out[k] = tuple(ids)

        while rows.shape[1] > 1:
            at = ranks.argmin(axis=1)
            joins = ranks[np.arange(len(at)), at] < LAST
            if not joins.all():
                finish(rows[~joins], own[~joins])
                rows, ranks, made, own, at = (x[joins] for x in (rows, ranks, made, own, at))
                if not len(rows):
                    return out
            n, width = rows.shape
            line = np.arange(n)
            rows[line, at] = made[line, at]
            keep = np.ones((n, width), bool)
            keep[line, at + 1] = False
            rows = rows[keep].reshape(n, width - 1)
            keep = np.ones((n, width - 1), bool)
            keep[line, at] = False
            ranks, made = (x[keep].reshape(n, width - 2) for x in (ranks, made))
            for beside in (at - 1, at):  # the pairs that the new symbol is in
                some = np.flatnonzero((beside >= 0) & (beside < width - 2))
                here = beside[some]
                ranks[some, here], made[some, here] = self._pairs_of(rows[some, here], rows[some, here + 1])
        finish(rows, own)
        return out

    def _learn(self, words: list[str]) -> None:
        """Remember the segmentations of new words, none longer than ``SHORT``."""
        words.sort(key=len)
        for k in range(0, len(words), TOGETHER):
            some = words[k : k + TOGETHER]
            self._memory.update(zip(some, self._merge_rows(some)))

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Built when a text is encoded; decoding needs none."""
        made = ahocorasick.Automaton()
        for name, (k, score) in self.scores.items():
            made.add_word(name, (len(name), k, score))
        made.make_automaton()
        return made

    def viterbi(self, text: str) -> tuple[int, ...]:
        """The best segmentation of ``text``, blanks already written as such."""
        if self.by_merges:
            tied = any(pair in text for pair in self._tied)
            return self._merged(text) if tied else self._walk(text)
        n = len(text)
        best: list[float] = [0.0] + [-1e300] * n
        last: list[tuple[int, int]] = [(1, -1)] * (n + 1)  # length and id of the last piece
        single = 0  # end of the latest piece of one character
        at = 0  # ends up to here are final
        for end, (length, piece, score) in self.automaton.iter(text):
            while at < end:
                at += 1
                if single != at and best[at - 1] + self.worst > best[at]:
                    best[at], last[at] = best[at - 1] + self.worst, (1, -1)
            end += 1
            if length == 1:
                single = end
            if best[end - length] + score > best[end]:
                best[end], last[end] = best[end - length] + score, (length, piece)
        for at in range(at + 1, n + 1):
            if single != at and best[at - 1] + self.worst > best[at]:
                best[at], last[at] = best[at - 1] + self.worst, (1, -1)
        out: list[int] = []
        at = n
        while at:
            length, piece = last[at]
            if piece >= 0:
                out.append(piece)
            else:
                out += [self.octets[b] for b in reversed(text[at - 1].encode())]
            at -= length
        return tuple(reversed(out))

    def encode(self, text: str) -> list[int]:
        """Ids of ``text``; none for an empty text."""
        if not text:
            return []
        text = BLANK + text.replace(" ", BLANK)
        if self._parts is None:
            return list(self.viterbi(text))
        memory, out = self._memory, []
        for part in self._parts.findall(text):
            ids = memory.get(part)
            if ids is None:
                ids = self.viterbi(part)
                if len(memory) >= REMEMBERED:
                    memory.clear()
                if len(part) <= SHORT:
                    memory[part] = ids
            out += ids
        return out

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """As ``encode``, for many texts at a time."""
        if self._parts is None or not self.by_merges:
            return [np.array(self.encode(text), np.int32) for text in texts]
        split = [self._parts.findall(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        words = set(chain.from_iterable(split))
        memory = self._memory
        new = [word for word in words if word not in memory]
        if len(memory) + len(new) > REMEMBERED:
            memory.clear()
            new = list(words)
        long = [word for word in new if len(word) > SHORT]
        memory.update(zip(long, map(self.viterbi, long)))
        self._learn([word for word in new if len(word) <= SHORT])
        own = memory.__getitem__
        made = [np.fromiter(chain.from_iterable(map(own, parts)), np.int32) for parts in split]
        for word in long:
            del memory[word]
        if len(memory) > REMEMBERED:
            memory.clear()
        return made


_LOADED: dict[tuple[type, int], Table] = {}


def _load[Kind: Table](model: bytes, kind: type[Kind]) -> Kind:
    """The vocabulary or its table, built once in a worker."""
    key = kind, hash(model)
    if key not in _LOADED:
        _LOADED[key] = kind(model)
    return _LOADED[key]


def _model(docs: DataFrame, path: str):
    """The model file as a broadcast; a vocabulary doesn't grow with the data."""
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _with(docs: DataFrame, carry: list[str], name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([docs.schema[c] for c in carry]).add(name, kind)


def encode(docs: DataFrame, model: str = MODEL, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, the ``carry`` columns and ids, an array.

    NULL and empty texts have no ids. Repeated rows are all returned. A carried column
    named ids gives way to the result; other columns are dropped. A U+2581 in a text
    is a blank to the model and comes back as one.
    """
    file = _model(docs, model)
    carry = ["doc_id", *(c for c in carry if c not in ("doc_id", "ids"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _load(file.value, Pieces)
        for batch in slices(batches):
            rows: list[np.ndarray] = []
            held, size = [], 0
            for text in texts(batch):
                held.append(text.decode())
                size += len(text)
                if size >= PORTION:
                    rows += pieces.encode_all(held)
                    held, size = [], 0
            rows += pieces.encode_all(held)
            ends = np.cumsum([0, *map(len, rows)], dtype=np.int64)
            flat = np.concatenate(rows)
            made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*map(batch.column, carry), made], [*carry, "ids"])
        pieces.forget()

    taken = docs.select(*carry, *(["text"] if "text" not in carry else []))
    return taken.transform(in_batches(run, _with(docs, carry, "ids", T.ArrayType(T.IntegerType()))))


def decode(encoded: DataFrame, model: str = MODEL, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``encoded``: doc_id, the ``carry`` columns and decoded, the
    text of ids. NULL and empty arrays are the empty text; ids that the model doesn't
    have fail the job."""
    file = _model(encoded, model)
    carry = ["doc_id", *(c for c in carry if c not in ("doc_id", "decoded"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _load(file.value, Table)
        for batch in slices(batches):
            made = [
                table.decode(row.values.to_numpy(zero_copy_only=False).tolist()) if row.is_valid else ""
                for row in batch.column("ids")
            ]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, carry), pa.array(made, pa.string())], [*carry, "decoded"]
            )

    taken = encoded.select(*carry, *(["ids"] if "ids" not in carry else []))
    return taken.transform(in_batches(run, _with(encoded, carry, "decoded", T.StringType())))
