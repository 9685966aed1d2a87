"""SentencePiece-style encoding and decoding.

The vocabulary file gives pieces and scores.  An Aho-Corasick automaton over the pieces reads the
text once; at each position its output links name every piece that ends there, and each relaxes
the best score of that position (Viterbi).  The segmentation is the one with the highest sum of
piece scores.  Characters that no piece covers become byte pieces.

Spaces are read as the vocabulary's space mark, with one space put before the text.  A space mark
that the text itself contains is encoded as bytes, so decoding gives back every text exactly.
"""

from __future__ import annotations

import itertools
import os
import re
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import map_batches
from .text import as_bytes, groups, slices

MARK = "▁"
#: Words whose segmentation a worker remembers; later ones are solved again in each block of text.
REMEMBERED = 300_000
VOCABULARY = os.environ.get("IRSPARK_PIECES", "/opt/tokenizers/piece_bpe_32k.model")


def load_vocabulary(path: str = VOCABULARY) -> list[tuple[str, float, int]]:
    """(piece, score, byte or -1) by id; control and unknown pieces are empty strings.  Read on the
    driver; the list (as long as the vocabulary) goes to the tasks."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        byte = int(piece[3:5], 16) if sp.is_byte(i) else -1
        plain = not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        out.append((piece.replace(MARK, " ") if plain else "", sp.get_score(i), byte))
    return out


class Pieces:
    """Encoder and decoder over a list of pieces.  Of equal scores the longer last piece wins."""

    def __init__(self, vocabulary: list[tuple[str, float, int]]):
        plain = [(p, s, i) for i, (p, s, _) in enumerate(vocabulary) if p]
        self.byte_ids = {b: i for i, (_, _, b) in enumerate(vocabulary) if b >= 0}
        self.raw = [bytes([b]) if b >= 0 else p.encode() for p, _, b in vocabulary]
        self.floor = min((s for _, s, _ in plain), default=0.0) - 10.0   # a character without a piece
        self.step: list[dict[str, int]] = [{}]
        self.out: list[tuple[int, float, int] | None] = [None]
        for p, s, i in plain:
            at = 0
            for ch in p:
                if ch not in self.step[at]:
                    self.step[at][ch] = len(self.step)
                    self.step.append({})
                    self.out.append(None)
                at = self.step[at][ch]
            if self.out[at] is None:
                self.out[at] = (len(p), s, i)
        self.fail = [0] * len(self.step)
        self.link = [0] * len(self.step)                          # nearest shorter suffix that is a piece
        queue = deque(self.step[0].values())
        while queue:
            at = queue.popleft()
            for ch, to in self.step[at].items():
                f = self.fail[at]
                while f and ch not in self.step[f]:
                    f = self.fail[f]
                self.fail[to] = self.step[f].get(ch, 0) if at else 0
                self.link[to] = self.fail[to] if self.out[self.fail[to]] else self.link[self.fail[to]]
                queue.append(to)
        # A piece that goes on after a non-space with a space, or holds a line end, would cross a cut.
        cut_space = not any(re.search(r"[^ ] ", p) for p, _, _ in plain)
        cut_line = not any("\n" in p for p, _, _ in plain)
        self.by_space = cut_space and cut_line
        self.units = re.compile(r" *[^ \n]+| +|\n" if cut_space and cut_line else r" *[^ ]+| +" if cut_space else r"(?s).+")
        self.memory: dict[str, bytes] = {}
        self._arrays()

    def _arrays(self) -> None:
        """The automaton as arrays, to read many words at once."""
        chars = sorted({ch for edges in self.step for ch in edges})
        self.char = np.zeros(0x110000, np.int64)
        self.char[[ord(ch) for ch in chars]] = np.arange(1, len(chars) + 1)
        self.width = len(chars) + 1
        edges = sorted((at * self.width + int(self.char[ord(ch)]), to)
                       for at, step in enumerate(self.step) for ch, to in step.items())
        self.edge_key = np.array([k for k, _ in edges] + [np.iinfo(np.int64).max], np.int64)
        self.edge_to = np.array([to for _, to in edges] + [0], np.int64)
        # The 127 characters with the most edges have a full table, failure links resolved.
        uses = np.bincount(self.edge_key[:-1] % self.width, minlength=self.width)
        self.common = np.zeros(self.width, np.int64)
        self.common[np.argsort(-uses, kind="stable")[:127]] = np.arange(1, min(127, self.width) + 1)
        self.table = np.zeros((len(self.step), 128), np.int32)
        queue = deque([0])
        while queue:
            at = queue.popleft()
            if at:
                self.table[at] = self.table[self.fail[at]]
            for ch, to in self.step[at].items():
                self.table[at, self.common[self.char[ord(ch)]]] = to
                queue.append(to)
        self.table[:, 0] = -1                                     # other characters
        self.fails, self.links = np.array(self.fail), np.array(self.link)
        self.ends = np.array([o is not None for o in self.out])
        self.lens = np.array([o[0] if o else 0 for o in self.out])
        self.scores = np.array([o[1] if o else 0.0 for o in self.out])
        self.ids = np.array([o[2] if o else -1 for o in self.out], np.int32)
        self.first = np.where(self.ends, np.arange(len(self.out)), self.links)
        self.raw_len = np.array([len(r) for r in self.raw])
        self.raw_at = np.cumsum(self.raw_len) - self.raw_len
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        # what an id adds to the score; the bytes of a character without a piece add the floor once
        self.worth = np.zeros(len(self.raw))
        self.worth[self.ids[self.ends]] = self.scores[self.ends]
        self.worth[[i for b, i in self.byte_ids.items() if b & 0xC0 != 0x80]] = self.floor

    def _advance(self, state: np.ndarray, ch: np.ndarray) -> np.ndarray:
        """One step of the automaton for many states, along failure links where need be."""
        to = self.table[state, self.common[ch]].astype(np.int64)
        open_ = np.flatnonzero(to < 0)
        to[open_] = 0
        while len(open_):
            key = state[open_] * self.width + ch[open_]
            at = np.searchsorted(self.edge_key, key)
            hit = self.edge_key[at] == key
            to[open_[hit]] = self.edge_to[at[hit]]
            open_ = open_[~hit & (state[open_] > 0)]
            state[open_] = self.fails[state[open_]]
        return to

    def solve(self, units: list[str]) -> dict[str, bytes]:
        """Best ids of each unit, as int32 bytes: the same pass as ``viterbi``, all units of a call
        moving on by one character at a time.  Units with unknown characters are done alone."""
        units.sort(key=len, reverse=True)
        sizes = np.array([len(u) for u in units])
        text = self.char[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)]
        at = np.cumsum(sizes) - sizes
        unknown = np.logical_or.reduceat(text == 0, at)
        wide = len(units)                                         # row i holds position i of every unit
        best = np.zeros((sizes[0] + 1, wide))
        size = np.zeros((sizes[0] + 1, wide), np.int64)
        piece = np.full((sizes[0] + 1, wide), -1, np.int32)
        flat, state = best.ravel(), np.zeros(wide, np.int64)
        for i in range(1, sizes[0] + 1):
            n = int(np.searchsorted(-sizes, -i, "right"))           # units of at least i characters
            state = self._advance(state[:n], text.take(at[:n] + i - 1))
            top, took, which = best[i - 1, :n] + self.floor, np.ones(n, np.int64), np.full(n, -1, np.int64)
            rows, node = np.arange(n), self.first.take(state)
            while True:
                some = np.flatnonzero(node)
                if not len(some):
                    break
                rows, node = rows.take(some), node.take(some)
                reach = flat.take((i - self.lens.take(node)) * wide + rows) + self.scores.take(node)
                up = np.flatnonzero(reach > top.take(rows))
                row, better = rows.take(up), node.take(up)
                top[row], which[row] = reach.take(up), better
                node = self.links.take(node)
            hit = which >= 0
            best[i, :n], size[i, :n] = top, np.where(hit, self.lens.take(which), took)
            piece[i, :n] = np.where(hit, self.ids.take(which), -1)
        rows, pos, back = np.arange(wide), sizes.copy(), []
        while len(rows):
            back.append((rows, piece[pos[rows], rows]))
            pos[rows] -= size[pos[rows], rows]
            rows = rows[pos[rows] > 0]
        who, ids = (np.concatenate(x) for x in zip(*back[::-1]))
        ids = ids[np.argsort(who, kind="stable")].astype(np.int32).tobytes()
        ends = 4 * np.cumsum(np.bincount(who, minlength=len(units)))
        out, first = {}, 0
        for u, last in zip(units, ends.tolist()):
            out[u] = ids[first:last]
            first = last
        for i in np.flatnonzero(unknown).tolist():
            out[units[i]] = self._alone(units[i])
        return out

    def _alone(self, unit: str) -> bytes:
        return np.array(self.viterbi(unit)[1], np.int32).tobytes()

    def _solved(self, units: set[str]) -> dict[str, bytes]:
        """Best ids of the given units that the memory did not have.  The first REMEMBERED solved
        units, which are mostly the frequent ones, are kept in it."""
        memory = self.memory
        new = [u for u in units if u not in memory]
        lines = {u: self.units.findall(u) for u in new if "\n" in u}
        if lines:
            new = {u for u in new if u not in lines}.union(*lines.values())
            new = [u for u in new if u not in memory]
        found = {u: self._alone(u) for u in new if len(u) > 64}
        short = sorted((u for u in new if len(u) <= 64), key=len)
        for first in range(0, len(short), 4096):
            found |= self.solve(short[first:first + 4096])
        for u, parts in lines.items():
            found[u] = b"".join([found[p] if p in found else memory[p] for p in parts])
        if len(memory) < REMEMBERED:
            memory.update(itertools.islice(found.items(), REMEMBERED - len(memory)))
        return found

    def viterbi(self, text: str) -> tuple[float, list[int]]:
        """Best score and ids of a text (no space added), in one pass."""
        step, fail, link, out = self.step, self.fail, self.link, self.out
        best, back, at = [0.0], [(0, -1)], 0
        for i, ch in enumerate(text, 1):
            while at and ch not in step[at]:
                at = fail[at]
            at = step[at].get(ch, 0)
            top, frm = best[i - 1] + self.floor, (i - 1, -1)
            node = at if out[at] else link[at]
            while node:                                           # longest piece first
                n, s, piece = out[node]
                if best[i - n] + s > top:
                    top, frm = best[i - n] + s, (i - n, piece)
                node = link[node]
            best.append(top)
            back.append(frm)
        ids, i = [], len(text)
        while i:
            j, piece = back[i]
            if piece >= 0:
                ids.append(piece)
            else:
                ids += [self.byte_ids[b] for b in reversed(text[j:i].encode())]
            i = j
        return best[-1], ids[::-1]

    def _split(self, text: str) -> list[str]:
        """Units of a text with its leading space: a space and what follows it.  Runs of spaces are
        kept whole, as the cuts allow."""
        if not text:
            return []
        parts = text.split(" ")
        return self.units.findall(" " + text) if "" in parts or not self.by_space else [" " + p for p in parts]

    def encode(self, texts: list[str]) -> list[tuple[float, np.ndarray]]:
        """Best score and ids of each text; units that no piece crosses are solved once."""
        split = [self._split(t) for t in texts]
        known = self._solved(set(itertools.chain.from_iterable(split)))
        flat = [np.frombuffer(b"".join([known[u] if u in known else self.memory[u] for u in units]), np.int32)
                for units in split]
        return [(float(self.worth[ids].sum()), ids) for ids in flat]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of an array of ids."""
        n, at = self.raw_len[ids], self.raw_at[ids]
        where = np.arange(n.sum()) + np.repeat(at - (np.cumsum(n) - n), n)
        return self.raw_bytes[where[1:]].tobytes()


_READY: dict[int, Pieces] = {}


def _pieces(shared) -> Pieces:
    """The automaton of a broadcast vocabulary, built once in each Python worker."""
    if shared.id not in _READY:
        _READY.clear()
        _READY[shared.id] = Pieces(shared.vocabulary.value)
    return _READY[shared.id]


class _Shared:
    def __init__(self, spark: SparkSession, vocabulary):
        self.vocabulary = spark.sparkContext.broadcast(vocabulary)
        self.id = hash(tuple(vocabulary))


def _encode(shared):
    def run(batches):
        pieces = _pieces(shared)
        for batch in slices(batches, 1):
            texts = as_bytes(batch.column(1))
            for first, last in groups(texts):
                rows, some = batch.slice(first, last - first), texts[first:last]
                scores, flat = zip(*pieces.encode([t.decode("utf-8") for t in some]))
                same = [pieces.decode(ids) == t for ids, t in zip(flat, some)]
                sizes = [len(ids) for ids in flat]
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()),
                                               pa.array(np.concatenate(flat)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(sizes, pa.int32()), ids, pa.array(scores, pa.float64()), pa.array(same)],
                    ["doc_id", "n_pieces", "piece_ids", "score", "round_trip"])
    return run


def _decode(shared):
    def run(batches):
        pieces = _pieces(shared)
        for batch in batches:
            texts = [pieces.decode(np.array(ids or [], np.int64)) for ids in batch.column(1).to_pylist()]
            text = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), text], ["doc_id", "text"])
    return run


def encode_pieces(docs: DataFrame, vocabulary: str | list = VOCABULARY, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, n_pieces, piece_ids, score and round_trip (decoding gave the text back) per document.

    ``vocabulary``: path of a model file, read on the driver only, or a list as ``load_vocabulary``
    gives.  Null and empty texts have no pieces and a score of 0.  Every row is encoded whole and on
    its own, repeated rows too.  Other columns are ignored.
    """
    entries = load_vocabulary(vocabulary) if isinstance(vocabulary, str) else vocabulary
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, _encode(_Shared(docs.sparkSession, entries)),
                           "doc_id bigint, n_pieces int, piece_ids array<int>, score double, round_trip boolean")


def decode_pieces(encoded: DataFrame, vocabulary: str | list = VOCABULARY, id_col: str = "doc_id",
                  ids_col: str = "piece_ids") -> DataFrame:
    """doc_id and text of each row of piece ids; null ids give the empty text."""
    entries = load_vocabulary(vocabulary) if isinstance(vocabulary, str) else vocabulary
    rows = encoded.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return map_batches(rows, _decode(_Shared(encoded.sparkSession, entries)), "doc_id bigint, text string")
