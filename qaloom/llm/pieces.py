"""SentencePiece BPE by vectorised merge rounds, and its decoding."""

from __future__ import annotations

import codecs
import heapq
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom.llm.shared import bound_batches, map_texts, text_of

SPACE = "▁"
NONE = np.iinfo(np.int64).max
CACHED_WORDS = 300_000
ROUNDS = 256
SLOT_BITS = 20

codecs.register_error("one_byte", lambda e: ("�", e.start + 1))


class Model:
    """Tables of a BPE model with byte fallback and identity normalisation.

    A symbol is a piece's id, or ``size + code point`` for a character without a
    piece. ``merged(left, right)`` is the piece that two symbols make, its rank the
    place of the piece's score among all scores, best first.
    """

    def __init__(self, proto: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.size = sp.vocab_size()
        ids = range(self.size)
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in ids]
        pieces = [sp.id_to_piece(i) for i in ids]
        if any(sp.is_unused(i) for i in ids) or sp.normalize(" ﬁ  x ") != "▁▁ﬁ▁▁x▁":
            raise ValueError("only BPE models with identity normalisation and no unused pieces")
        self.of = {p: i for i, p in enumerate(pieces) if not special[i]}
        if any(SPACE in p.lstrip(SPACE) for p in self.of):
            raise ValueError("a piece holds a space after a letter")
        byte = {pieces[i]: i for i in ids if sp.is_byte(i)}
        self.byte_ids = [byte[f"<0x{b:02X}>"] for b in range(256)]
        scores = np.array([sp.get_score(i) for i in ids])
        # the last place is that of piece -1, no piece
        self.rank = np.append(np.unique(-scores, return_inverse=True)[1].astype(np.int64), NONE)
        self.chars = np.arange(0x110000, dtype=np.int64) + self.size
        for p, i in self.of.items():
            if len(p) == 1:
                self.chars[ord(p)] = i
        pairs = {}
        for p, i in self.of.items():
            for cut in range(1, len(p)):
                left, right = self.symbol(p[:cut]), self.symbol(p[cut:])
                if left is not None and right is not None:
                    pairs[self.key(left, right)] = i
        self._hash(pairs)
        self.pairs = pairs
        joining = {c for p in self.of if len(p) > 1 for c in p} - {SPACE}
        inner = "".join(map(re.escape, sorted(joining)))
        # no piece runs over the edge of one of these parts
        self.words = re.compile(f"{SPACE}+[{inner}]*|[{inner}]+|.", re.DOTALL)
        self.surface = [
            b"" if sp.is_control(i)
            else " ⁇ ".encode() if sp.is_unknown(i)
            else bytes([self.byte_ids.index(i)]) if sp.is_byte(i)
            else pieces[i].replace(SPACE, " ").encode()
            for i in ids
        ]
        self.controls = {i for i in ids if sp.is_control(i)}
        self.spaced = {i for p, i in self.of.items() if p.startswith(SPACE)}

    def symbol(self, text: str) -> int | None:
        return int(self.chars[ord(text)]) if len(text) == 1 else self.of.get(text)

    def key(self, left, right):
        return left * (self.size + 0x110000) + right

    def _hash(self, pairs: dict[int, int]) -> None:
        """Lay the pairs out by a hash of their key, the next free slot on a clash."""
        self.keys = np.full(1 << SLOT_BITS, -1, dtype=np.int64)
        self.made = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        left_key = np.array(list(pairs), dtype=np.int64)
        left_made = np.array(list(pairs.values()), dtype=np.int64)
        at, self.probes = self._slot(left_key), 0
        while len(left_key):
            self.probes += 1
            free = np.flatnonzero(self.keys[at] < 0)
            put = free[np.unique(at[free], return_index=True)[1]]
            self.keys[at[put]], self.made[at[put]] = left_key[put], left_made[put]
            rest = np.setdiff1d(np.arange(len(at)), put)
            left_key, left_made, at = left_key[rest], left_made[rest], (at[rest] + 1) % len(self.keys)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces that pairs of symbols make, and their ranks (NONE where they make none)."""
        key = self.key(left, right)
        at = self._slot(key)
        there = self.keys[at]
        piece = np.where(there == key, self.made[at], -1)
        open_ = np.flatnonzero((there != key) & (there >= 0))
        for _ in range(1, self.probes):
            at[open_] = (at[open_] + 1) % len(self.keys)
            there = self.keys[at[open_]]
            hit = there == key[open_]
            piece[open_[hit]] = self.made[at[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return piece, self.rank[piece]

@lru_cache(maxsize=2)
def model_of(proto: bytes) -> Model:
    return Model(proto)


def merge_words(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All words' symbols when no pair can be merged any more, and each word's number of them.

    All words lie in one flat array of symbols. A round finds the best rank in each
    word and merges all its pairs of that rank, from the left and without overlap.
    Merging them at once is the same as one by one unless a merge makes a neighbour
    of the same or a better rank; in such a word only the leftmost pair is merged.
    Finished words leave the array. A word that still isn't finished after ``ROUNDS``
    rounds (thousands of repeated characters) is finished pair by pair from a heap.
    """
    finished: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    sym = model.chars[np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)]
    sizes = np.array([len(w) for w in words])
    name = np.arange(len(words))
    for _ in range(ROUNDS):
        if not len(name):
            break
        start = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        seg = np.repeat(np.arange(len(name)), sizes)
        inside = np.append(seg[1:] == seg[:-1], False)
        after = np.append(sym[1:], 0)
        piece, rank = model.merged(sym, after)
        rank[~inside] = NONE
        best = np.minimum.reduceat(rank, start)
        done = best == NONE
        finished.append((name[done], sizes[done], sym[done[seg]]))
        at = np.arange(len(sym))
        hit = inside & (rank == best[seg]) & ~done[seg]
        first = hit & ~np.append(False, hit[:-1])
        pick = hit & ((at - np.maximum.accumulate(np.where(first, at, 0))) % 2 == 0)
        i = np.flatnonzero(pick)
        new = piece[i]
        left = np.where((i > 1) & pick[i - 2], piece[i - 2], sym[i - 1])
        has_left = (i > 0) & (seg[i - 1] == seg[i])
        two = np.minimum(i + 2, len(sym) - 1)
        has_right = (i + 2 < len(sym)) & (seg[two] == seg[i])
        bar = best[seg[i]]
        early = (has_left & (model.merged(left, new)[1] <= bar)) | (
            has_right & (model.merged(new, sym[two])[1] <= bar)
        )
        alone = np.zeros(len(name), dtype=bool)
        alone[seg[i[early]]] = True
        leading = np.append(True, seg[i[1:]] != seg[i[:-1]]) if len(i) else np.empty(0, bool)
        i, new = i[keep := leading | ~alone[seg[i]]], new[keep]
        sym[i] = new
        stay = ~done[seg]
        stay[i + 1] = False
        sizes = sizes - np.bincount(seg[i], minlength=len(name))
        sym, sizes, name = sym[stay], sizes[~done], name[~done]
    for k, end, n in zip(name, np.cumsum(sizes), sizes):
        found = _merge_by_heap(model, sym[end - n : end].tolist())
        finished.append((np.array([k]), np.array([len(found)]), found))
    name, sizes, sym = (np.concatenate(x) for x in zip(*finished))
    order = np.argsort(np.repeat(name, sizes), kind="stable")
    return sym[order], sizes[np.argsort(name)]


def _merge_by_heap(model: Model, sym: list[int]) -> np.ndarray:
    """Merge the best pair, the leftmost of equals, until none is left."""
    ahead, behind = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int, j: int) -> None:
        if 0 <= i and j < len(sym) and (p := model.pairs.get(model.key(sym[i], sym[j]))) is not None:
            heapq.heappush(heap, (int(model.rank[p]), i, sym[i], sym[j]))

    for i in range(len(sym) - 1):
        offer(i, i + 1)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = ahead[i]
        if sym[i] != a or j >= len(sym) or sym[j] != b:
            continue
        sym[i], sym[j] = model.pairs[model.key(a, b)], -1
        ahead[i] = ahead[j]
        if ahead[j] < len(sym):
            behind[ahead[j]] = i
        offer(behind[i], i)
        offer(i, ahead[i])
    return np.array([s for s in sym if s >= 0], dtype=np.int64)


class Encoder:
    """Encodes texts; the ids of words seen before are looked up in a bounded store."""

    def __init__(self, proto: bytes):
        self.model = model_of(proto)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.start = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        model = self.model
        ids, sizes = merge_words(model, words)
        if len(plain := np.flatnonzero(ids >= model.size)):
            spelled = [[model.byte_ids[b] for b in chr(s - model.size).encode()] for s in ids[plain].tolist()]
            width = np.ones(len(ids), dtype=np.int64)
            width[plain] = [len(x) for x in spelled]
            owner = np.repeat(np.arange(len(words)), sizes)
            sizes = np.bincount(owner, weights=width, minlength=len(words)).astype(np.int64)
            ids = np.repeat(ids, width)
            ids[ids >= model.size] = [b for x in spelled for b in x]
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        self.start = np.append(self.start, len(self.ids) + np.cumsum(sizes) - sizes)
        self.size = np.append(self.size, sizes)
        self.ids = np.append(self.ids, ids.astype(np.int32))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the number of ids of each text."""
        parts = [self.model.words.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        words = list(chain.from_iterable(parts))
        if len(self.place) > CACHED_WORDS:
            self.clear()
        places = list(map(self.place.get, words))
        if missing := [i for i, p in enumerate(places) if p is None]:
            self._learn(list(dict.fromkeys(words[i] for i in missing)))
            for i in missing:
                places[i] = self.place[words[i]]
        at = np.array(places, dtype=np.int64)
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        flat = self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[at] - (ends - sizes), sizes)]
        upto = np.concatenate(([0], ends))[np.cumsum([0] + [len(p) for p in parts])]
        return flat, np.diff(upto)


def decode_ids(model: Model, ids: list[int]) -> str:
    """The text of a list of ids; an undecodable byte becomes U+FFFD, an id out of range an IndexError.

    Control ids have no text, and bytes on both sides of one aren't read together.
    """
    runs: list[list[int]] = [[]]
    if model.controls.isdisjoint(ids):
        runs = [ids]
    else:
        for i in ids:
            if i in model.controls:
                runs.append([])
            else:
                runs[-1].append(i)
    lead = next((run[0] for run in runs if run), None)
    data = [b"".join([model.surface[i] for i in run]) for run in runs]
    text = "".join(d.decode("utf-8", "one_byte") for d in data)
    return text[1:] if lead in model.spaced else text


@lru_cache(maxsize=2)
def _encoder(proto: bytes) -> Encoder:
    return Encoder(proto)


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(flat, pa.int32())
    )


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``ids`` and ``decoded`` (what the ids decode to) for every row of ``docs``.

    Ids are those of the model without begin or end ids and without sampling; a null
    text is read as empty and has no ids. Each row is worked on alone: repeated rows
    and null ids are returned as they came, other columns are not read, and a long
    text is one row's work of any length. The model (half a megabyte) travels with
    the task, so executors need no file.
    """
    with open(model_path, "rb") as file:
        proto = file.read()

    def job(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = _encoder(proto)
        flat, counts = encoder.encode(batch.column("text").to_pylist())
        ends = np.cumsum(counts)
        decoded = [decode_ids(encoder.model, flat[e - n : e].tolist()) for e, n in zip(ends, counts)]
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), _lists(flat, counts), pa.array(decoded, pa.string())], ["id", "ids", "decoded"]
        )

    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(F.col(f"`{text_col}`")).alias("text"))
    return map_texts(given, "text", "id long, ids array<int>, decoded string", job)


def decode(rows: DataFrame, model_path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``id`` and ``text`` for rows of ids; null ids decode to the empty text."""
    with open(model_path, "rb") as file:
        proto = file.read()

    def run(batches):
        model = model_of(proto)
        for batch in batches:
            texts = [decode_ids(model, ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    bound_batches(rows.sparkSession)
    given = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    return given.mapInArrow(run, "id long, text string")
