"""SentencePiece encoding with seeded merge-dropout, and decoding.

A word (blanks before it included) starts as its characters. The agenda holds every pair of neighbours whose
joined piece is in the vocabulary, best piece first, the leftmost of equal ones first. A pair taken from it is skipped with probability
``dropout``; otherwise it is merged and its new neighbours enter the agenda. A
skipped pair comes back only when one of its sides has changed. Characters without a piece become their bytes. With dropout
0 the ids are those of the sentencepiece library.

Which turns of the agenda are skipped is a keyed hash of the seed, the text, the place of the word in it and the number of the skip: the hash
gives the number of turns until the next skip, which is the same as a draw at every turn. So every occurrence of a word is drawn
for itself. What a word becomes depends on the skipped turns only, so results are remembered, up to a bound, by word and skipped turns; most
occurrences skip none or one. Equal texts get equal ids, on every run and machine. Many new results go through the agenda at
once, as rows of a matrix; words that hold bytes go one by one, with a heap, and so does every occurrence of a very long word.

Decoding joins the pieces and drops the blank that encoding put in front, so every text comes back as it was; a literal "▁" is kept by
writing it as bytes. The vocabulary must have no piece with a blank after another character, nor one with a line break; loading checks it.

Defined results: null text is empty and has no pieces. Repeated rows are encoded one by one. Extra columns are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from topicstream.llm.common import mix64

BLANK = "▁"
UNITS = re.compile(rf"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+")
LITERAL = "\n" + BLANK  # no word of the pattern looks like this
NEVER = np.int32(2**31 - 1)


@dataclass(frozen=True)
class Settings:
    dropout: float = 0.1
    seed: int = 17
    cached_words: int = 1_000_000  # with their skipped turns; those met again stay when it is full
    longest: int = 24  # characters of a word whose results are remembered


class Words(dict):
    """Numbers of known words without a skip; new ones are numbered in turn and noted."""

    def __init__(self, owner: Encoder):
        self.owner = owner

    def __missing__(self, word: str) -> int:
        at = self[word] = self.owner.note(word, ())
        return at


class Encoder:
    """Encodes and decodes with one vocabulary."""

    def __init__(self, path: str, settings: Settings = Settings()):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        numbers = range(model.vocab_size())
        plain = [i for i in numbers if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.id_of = {model.id_to_piece(i): i for i in plain}
        self.byte_id = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(BLANK in p.lstrip(BLANK) or "\n" in p for p in self.id_of):
            raise ValueError("the vocabulary has pieces that cross words or lines")
        self.settings, self.size = settings, len(numbers)
        self.content = [b""] * self.size
        for piece, i in self.id_of.items():
            self.content[i] = piece.replace(BLANK, " ").encode()
        for b, i in enumerate(self.byte_id):
            self.content[i] = bytes([b])
        self.id_of_code = np.full(0x10000, -1, np.int32)
        for piece, i in self.id_of.items():
            if len(piece) == 1 and ord(piece) < 0x10000:
                self.id_of_code[ord(piece)] = i
        # the order in which joined pieces leave the agenda
        order = {i: r for r, i in enumerate(sorted(plain, key=lambda i: (-model.get_score(i), i)))}
        pairs = {}
        for piece, i in self.id_of.items():
            for cut in range(1, len(piece)):
                a, b = self.id_of.get(piece[:cut]), self.id_of.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = (order[i], i)
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k][0] for k in self.pair_keys.tolist()], np.int32)
        self.pair_id = np.array([pairs[k][1] for k in self.pair_keys.tolist()], np.int32)
        self.reset()

    def reset(self) -> None:
        self.words, self.after_skip = Words(self), {}
        self.known, self.new = 0, []
        self.starts, self.sizes, self.hits, self.turns = (np.zeros(0, np.int64) for _ in range(4))
        self.flat = np.zeros(0, np.int32)
        self.made_of: list[tuple[str, tuple[int, ...]]] = []

    def note(self, word: str, skips: tuple[int, ...]) -> int:
        self.new.append((word, skips))
        return self.known + len(self.new) - 1

    def forget(self) -> None:
        """Keep the results met at least twice, if they are few enough."""
        keep = self.hits > 1
        if keep.sum() > self.settings.cached_words // 2:
            self.reset()
            return
        number = np.cumsum(keep) - 1
        kept = [(w, n) for w, n in self.words.items() if keep[n]]
        self.words.clear()
        self.words.update((w, int(number[n])) for w, n in kept)
        self.after_skip = {
            (int(number[c >> 32]) << 32) | (c & 0xFFFFFFFF): int(number[n]) for c, n in self.after_skip.items() if keep[n] and keep[c >> 32]
        }
        self.made_of = [m for m, k in zip(self.made_of, keep, strict=True) if k]
        starts, sizes = self.starts[keep], self.sizes[keep]
        ends = np.cumsum(sizes)
        self.flat = self.flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]
        self.turns = self.turns[keep]
        self.starts, self.sizes, self.hits, self.known = ends - sizes, sizes, np.zeros(len(sizes), np.int64), len(sizes)

    def gaps(self, key: np.ndarray, number: int) -> np.ndarray:
        """Turns before the next skip, the ``number``-th one, of the occurrences with these keys."""
        if self.settings.dropout >= 1:
            return np.zeros(len(key), np.int64)
        u = ((mix64(key + np.uint64((number + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        return np.minimum(np.log(u) / np.log1p(-self.settings.dropout), 1e9).astype(np.int64)

    def skip_turns(self, key: int) -> Iterator[int]:
        """The skipped turns of one occurrence, one after another."""
        turn = -1
        for number in itertools.count():
            turn += 1 + int(self.gaps(np.array([key], np.uint64), number)[0])
            yield turn

    def by_heap(self, word: str, skips: Iterator[int]) -> tuple[list[int], int]:
        """One word through a heap: its pieces and the number of turns."""
        if word == LITERAL:
            return [self.byte_id[b] for b in BLANK.encode()], 0
        ids: list[int | None] = [self.id_of.get(c) for c in word]
        after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        agenda, turn, next_skip = [], 0, next(skips, -1)
        alive = [True] * len(word)

        def offer(left: int) -> None:
            right = after[left]
            if left >= 0 and right < len(word) and ids[left] is not None and ids[right] is not None:
                found = self.pairs.get(ids[left] * self.size + ids[right])
                if found:
                    heapq.heappush(agenda, (found[0], left, right, ids[left], ids[right], found[1]))

        for i in range(len(word) - 1):
            offer(i)
        while agenda:
            _, left, right, a, b, joined = heapq.heappop(agenda)
            if not alive[left] or not alive[right] or ids[left] != a or ids[right] != b or after[left] != right:
                continue
            turn += 1
            if turn - 1 == next_skip:
                next_skip = next(skips, -1)
                continue
            ids[left], alive[right] = joined, False
            after[left] = after[right]
            if after[right] < len(word):
                before[after[right]] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        out: list[int] = []
        for i, c in enumerate(word):
            if alive[i]:
                out += [ids[i]] if ids[i] is not None else [self.byte_id[b] for b in c.encode()]
        return out, turn

    def look_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NEVER without a joined piece) and joined piece of pairs; ids below 0 are the end of a word."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        good = (self.pair_keys[at] == key) & (b >= 0) & (a >= 0)
        return np.where(good, self.pair_rank[at], NEVER), self.pair_id[at]

    def by_matrix(self, pieces: np.ndarray, skips: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of the same length as rows of single-character pieces: one turn of every word's agenda at a time.

        Returns the numbers of pieces, all pieces one after another, and the numbers of turns.
        """
        n, length = pieces.shape
        ids = np.full((n, length + 2), -1, np.int32)
        ids[:, :length] = pieces
        planned = np.full((n, max(map(len, skips)) + 1), -1, np.int64)
        for i, turns_of in enumerate(skips):
            planned[i, : len(turns_of)] = turns_of
        turns, done = np.zeros(n, np.int64), np.zeros(n, np.int64)
        rank, joined = self.look_up(ids[:, :-1].ravel(), ids[:, 1:].ravel())
        rank, joined = rank.reshape(n, -1), joined.reshape(n, -1)
        columns, rows = np.arange(length + 2), np.arange(n)
        while len(rows):
            place = rank[rows].argmin(axis=1)
            more = rank[rows, place] != NEVER
            rows, place = rows[more], place[more]
            skip = planned[rows, done[rows]] == turns[rows]
            done[rows] += skip
            turns[rows] += 1
            rank[rows[skip], place[skip]] = NEVER
            r, p = rows[~skip], place[~skip]
            if len(r):
                ids[r, p] = joined[r, p]
                moved = np.minimum(columns + (columns > p[:, None]), length + 1)
                ids[r] = ids[r[:, None], moved]
                moved = np.minimum(moved[:, :-1], length)
                for matrix in (rank, joined):
                    matrix[r] = matrix[r[:, None], moved]
                ids[r, -1] = -1
                for at in (p - 1, p):
                    inside = at >= 0
                    x, y = r[inside], at[inside]
                    rank[x, y], joined[x, y] = self.look_up(ids[x, y], ids[x, y + 1])
                rank[r, -1] = NEVER
        left = ids >= 0
        return left.sum(axis=1), ids[left], turns

    def settle(self) -> None:
        """Encode the new words, each with its skipped turns."""
        if not self.new:
            return
        words, skips = [w for w, _ in self.new], [k for _, k in self.new]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        first = np.cumsum(lengths) - lengths
        pieces = np.where(codes < 0x10000, self.id_of_code[np.minimum(codes, 0xFFFF)], -1)
        fits = (lengths > 1) & (np.minimum.reduceat(pieces, first) >= 0)
        starts, sizes, turns = (np.zeros(len(words), np.int64) for _ in range(3))
        parts, end = [self.flat], len(self.flat)
        for length in np.unique(lengths[fits]):
            every = np.flatnonzero(fits & (lengths == length))
            for at in range(0, len(every), 10_000):
                members = every[at : at + 10_000]
                count, flat, turns[members] = self.by_matrix(pieces[first[members][:, None] + np.arange(length)], [skips[i] for i in members])
                sizes[members], starts[members] = count, end + np.cumsum(count) - count
                parts.append(flat)
                end += len(flat)
        for i in np.flatnonzero(~fits):
            flat, turns[i] = self.by_heap(words[i], iter(skips[i]))
            sizes[i], starts[i] = len(flat), end
            parts.append(np.array(flat, np.int32))
            end += len(flat)
        self.append(starts, sizes, turns, parts)

    def append(self, starts: np.ndarray, sizes: np.ndarray, turns: np.ndarray, parts: list[np.ndarray]) -> None:
        self.starts, self.sizes, self.flat = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes]), np.concatenate(parts)
        self.turns = np.concatenate([self.turns, turns])
        self.hits = np.concatenate([self.hits, np.zeros(len(starts), np.int64)])
        self.made_of += self.new
        self.known, self.new = self.known + len(starts), []

    def with_skips(self, at: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The results of occurrences, from the numbers of their words without a skip and the keys of their places."""
        if not self.settings.dropout:
            return at
        alive, turn = np.arange(len(at)), np.full(len(at), -1, np.int64)
        for number in itertools.count():
            turn = turn + 1 + self.gaps(key[alive], number)
            inside = turn < self.turns[at[alive]]
            alive, turn = alive[inside], turn[inside]
            if not len(alive):
                return at
            codes, which = np.unique((at[alive] << 32) | turn, return_inverse=True)
            found = np.empty(len(codes), np.int64)
            for i, code in enumerate(codes.tolist()):
                node = self.after_skip.get(code)
                if node is None:
                    word, skips = self.made_of[code >> 32]
                    node = self.after_skip[code] = self.note(word, (*skips, code & 0xFFFFFFFF))
                found[i] = node
            self.settle()
            at[alive] = found[which]

    def units(self, text: str) -> list[str]:
        """Words of a text with their blanks; a literal blank mark is a word of its own, ``LITERAL``."""
        if not text:
            return []
        if BLANK not in text:
            return UNITS.findall(BLANK + text.replace(" ", BLANK))
        found = []
        for i, part in enumerate(text.split(BLANK)):
            found += [LITERAL] if i else []
            part = (BLANK if i == 0 else "") + part.replace(" ", BLANK)
            found += UNITS.findall(part)
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.units(t) for t in texts]
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        total = int(lengths.sum())
        words = list(itertools.chain.from_iterable(split))
        keys = np.array([xxhash.xxh3_64_intdigest(t.encode(), seed=self.settings.seed) for t in texts], np.uint64)
        place = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        key = mix64(np.repeat(keys, lengths) + place.astype(np.uint64))
        long = {i: words[i] for i in np.flatnonzero(np.fromiter(map(len, words), np.int64, total) > self.settings.longest).tolist()}
        for i in long:
            words[i] = BLANK
        at = np.fromiter(map(self.words.__getitem__, words), np.int64, total)
        self.settle()
        at = self.with_skips(at, key)
        flats = []
        for i, word in long.items():  # every occurrence on its own
            flats.append(np.array(self.by_heap(word, self.skip_turns(int(key[i])) if self.settings.dropout else iter(()))[0], np.int32))
            at[i] = self.note(word, ())
        if flats:
            sizes = np.array([len(f) for f in flats])
            self.append(len(self.flat) + np.cumsum(sizes) - sizes, sizes, np.zeros(len(flats), np.int64), [self.flat, *flats])
        self.hits += np.bincount(at, minlength=self.known)
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        pieces = int(ends[-1]) if total else 0
        ids = self.flat[np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(pieces)]
        bounds = np.concatenate([[0], ends])[np.cumsum(np.concatenate([[0], lengths]))]
        if self.known > self.settings.cached_words:
            self.forget()
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.content.__getitem__, ids.tolist())).decode()[1:]


@functools.lru_cache(maxsize=1)
def encoder(path: str, settings: Settings) -> Encoder:
    """One per worker process."""
    return Encoder(path, settings)


def runs(texts: list[str], most: int = 8_000_000) -> Iterator[tuple[int, list[str]]]:
    """Slices of a bounded number of characters, with their first row."""
    at = 0
    while at < len(texts):
        upto, held = at, 0
        while upto < len(texts) and (upto == at or held + len(texts[upto]) <= most):
            held += len(texts[upto])
            upto += 1
        yield at, texts[at:upto]
        at = upto


def gathered(batches: Iterator[pa.RecordBatch], most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Batches put together up to a bounded number of bytes, so that more new words go through the agenda at once."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def encode(docs: DataFrame, path: str, settings: Settings = Settings()) -> DataFrame:
    """``docs`` (doc_id, text) to doc_id and ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for at, part in runs(texts):
                ids = pa.array(encoder(path, settings).encode(part), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(part)), ids], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, settings: Settings = Settings()) -> DataFrame:
    """``encoded`` (doc_id, ids) to doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [encoder(path, settings).decode(x.values.to_numpy()) if x.is_valid else "" for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (little-endian 32-bit ids), decoded_crc32 (UTF-8) and whether the decoded text is the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, settings)
        for batch in gathered(batches):
            rows = []
            for _, part in runs([x or "" for x in batch.column("text").to_pylist()]):
                for text, ids in zip(part, coder.encode(part), strict=True):
                    back = coder.decode(ids)
                    rows.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(back.encode()), back == text))
            if not rows:
                continue
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.int64()] * 3 + [pa.bool_()], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    names = ["doc_id", "n_pieces", "ids_crc32", "decoded_crc32", "lossless"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, n_pieces long, ids_crc32 long, decoded_crc32 long, lossless boolean"
    return docs.select("doc_id", "text").mapInArrow(run, ddl)
