"""SentencePiece encoding by sampling from the piece lattice, and decoding.

A text is segmented by forward filtering and backward sampling: forward sums
give every position the total weight of the segmentations that reach it, and
pieces are then drawn from the end backwards in proportion, so a whole
segmentation is drawn with its probability (its weight to the power ``theta``,
normalised). The vocabulary is that of a given SentencePiece model and is read,
never trained; a piece of rank r among the merges weighs 1 / (r + 2).

Draws come from a hash of the row key (doc_id), ``seed``, the word's number in
the text and the step within the word, so a row's segmentation does not depend
on how rows are dealt out, and every rerun gives the same one.

No piece of such a vocabulary crosses from a word into the blanks before the
next, or holds a line end; the lattice falls apart there, and this is checked
when the model is read. Words (with the blanks before them) are therefore drawn
independently, all words of a block of texts at once: the lattice of each
distinct word is built once per task, and a step draws one piece for every
unfinished word.

Characters without a piece of their own, line ends and the model's blank mark
itself among them, become the pieces of their bytes. Decoding joins the pieces'
bytes and takes off the blank that encoding puts in front, so
decode(encode(text)) is text for every text. Null texts count as empty, an
empty text has no pieces; null doc_ids share one key. Rows that repeat a doc_id and text get the same
segmentation. A text of any length is segmented whole, in blocks of words. An empty table gives no rows. Other columns
than doc_id and text are not read, so their names can't clash.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import NO_ID, or_empty
from .windows import U, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THETA, SEED = 1.0, 1
#: Bytes of text drawn at once, rows decoded at once; edges kept by a task before it starts afresh. All bound memory only.
BLOCK, ROWS, EDGES = 1 << 18, 512, 1_500_000
WORDS = re.compile(rb" +[^ \n]*|\n[^ \n]*")


def read_model(path: str = MODEL) -> dict:
    """Pieces of the model: bytes -> (id, log weight), and the bytes of all ids."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, raw = {}, []
    for i in range(m.get_piece_size()):
        if m.is_byte(i):
            raw.append(bytes([int(m.id_to_piece(i)[3:5], 16)]))
            continue
        if m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
            raw.append(b"")
            continue
        text = m.id_to_piece(i).replace("▁", " ")
        if re.search(r"[^ ] |\n", text):
            raise ValueError(f"piece {i} crosses words: {text!r}")
        raw.append(text.encode())
        rank = min(-m.get_score(i), float(m.get_piece_size()))
        pieces[text.encode()] = (i, -math.log(rank + 2))
    bytes_at = {m.id_to_piece(i): i for i in range(m.get_piece_size()) if m.is_byte(i)}
    return {"pieces": pieces, "raw": raw, "bytes": [bytes_at[f"<0x{b:02X}>"] for b in range(256)]}


class Trie:
    """The vocabulary as a trie in arrays: node 0 is the root; a step from a
    node by a byte is looked up among sorted (node, byte) keys."""

    def __init__(self, pieces: dict[bytes, tuple[int, float]]):
        nodes: dict[bytes, int] = {b"": 0}
        for p in sorted(pieces):
            for n in range(1, len(p) + 1):
                nodes.setdefault(p[:n], len(nodes))
        self.piece = np.full(len(nodes), -1, np.int32)
        self.weight = np.zeros(len(nodes))
        for p, (i, w) in pieces.items():
            self.piece[nodes[p]], self.weight[nodes[p]] = i, w
        steps = sorted((nodes[p[:-1]] << 8 | p[-1], k) for p, k in nodes.items() if p)
        self.key = np.array([k for k, _ in steps], np.int64)
        self.to = np.array([k for _, k in steps], np.int64)
        self.first = np.full(1 << 16, -1, np.int64)  # by the first two bytes
        for p, k in nodes.items():
            if len(p) == 2:
                self.first[p[0] << 8 | p[1]] = k
        self.single = np.zeros(256, np.int64)  # by the first byte; 0: none
        for p, k in nodes.items():
            if len(p) == 1:
                self.single[p[0]] = k

    def matches(self, arr: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
        """start, end and node of every piece that begins at ``at`` and ends
        by ``end``."""
        out = []
        node = self.single[arr[at]]
        at, end, node = (x[node > 0] for x in (at, end, node))
        depth = 1
        while len(at):
            hit = self.piece[node] >= 0
            out.append((at[hit], at[hit] + depth, node[hit]))
            on = at + depth < end
            at, end, node = at[on], end[on], node[on]
            byte = arr[at + depth].astype(np.int64)
            if depth == 1:
                node = self.first[arr[at].astype(np.int64) << 8 | byte]
                on = node >= 0
            else:
                want = node << 8 | byte
                k = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
                on, node = self.key[k] == want, self.to[k]
            at, end, node = at[on], end[on], node[on]
            depth += 1
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


class Lattice:
    """Lattices of distinct words. A state is a place in a word; its edges are
    the pieces that end there, their shares summed up to 2**32."""

    def __init__(self, model: dict, theta: float):
        self.trie = model["trie"] if "trie" in model else Trie(model["pieces"])
        self.bytes, self.theta = np.array(model["bytes"], np.int32), theta
        self.clear()

    def clear(self) -> None:
        self.words: dict[bytes, int] = {}
        self.states = self.edges = 0
        self._key, self._back, self._piece = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int32)

    @property
    def key(self) -> np.ndarray:
        return self._key[:self.edges]

    def _append(self, *new: np.ndarray) -> None:
        """Edges after those there are; the arrays grow by half as much again, so that few blocks copy them."""
        n = self.edges + len(new[0])
        for name, x in zip(("_key", "_back", "_piece"), new):
            old = getattr(self, name)
            if n > len(old):
                more = np.empty(n + n // 2, old.dtype)
                more[:self.edges] = old[:self.edges]
                setattr(self, name, more)
            getattr(self, name)[self.edges:n] = x
        self.edges = n

    def add(self, words: list[bytes]) -> None:
        """Builds the lattices of new, distinct words, all at once."""
        arr = np.frombuffer(b"".join(words), np.uint8)
        size = np.array([len(w) for w in words], np.int64)
        end = np.cumsum(size)
        word = np.repeat(np.arange(len(words)), size)
        # characters: first bytes and lengths; words are whole characters
        head = np.flatnonzero(arr & 0xC0 != 0x80)
        wide = np.diff(np.append(head, len(arr)))
        src, dst, node = self.trie.matches(arr, head, end[word[head]])
        weight, piece = self.theta * self.trie.weight[node], self.trie.piece[node]
        # a character that is no piece is spelt in bytes
        length = np.zeros(len(arr), np.int64)
        length[head] = wide
        known = np.zeros(len(arr), bool)
        known[src[dst - src == length[src]]] = True
        spelt = np.flatnonzero(~known[np.repeat(head, wide)])
        src, dst = np.concatenate([src, spelt]), np.concatenate([dst, spelt + 1])
        weight = np.concatenate([weight, np.zeros(len(spelt))])
        piece = np.concatenate([piece, self.bytes[arr[spelt]]])
        # states: byte i of word k is state i + k, its end one more
        own = word[src]
        place = dst - (end - size)[own]
        order = np.lexsort((src, own, place))
        src, dst, weight, piece, place = src[order] + own[order], dst[order] + own[order], weight[order], piece[order], place[order]
        forward = np.full(len(arr) + len(words), -np.inf)
        forward[end - size + np.arange(len(words))] = 0.0
        share = np.zeros(len(src), np.int64)
        cuts = np.flatnonzero(np.diff(place, prepend=-1))
        for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(place)]):
            w, to = forward[src[a:z]] + weight[a:z], dst[a:z]
            first = np.flatnonzero(np.diff(to, prepend=-1))
            n = np.diff(np.append(first, z - a))
            top = np.maximum.reduceat(w, first)
            top[~np.isfinite(top)] = 0.0  # a place inside a character that no segmentation reaches
            p = np.exp(w - np.repeat(top, n))
            total = np.add.reduceat(p, first)
            with np.errstate(divide="ignore"):
                forward[to[first]] = top + np.log(total)
            # whole numbers, so that sums do not depend on the other words here
            part = (p / np.repeat(np.maximum(total, 1e-300), n) * 2.0**32).astype(np.int64)
            upto = np.cumsum(part)
            upto -= np.repeat(upto[first] - part[first], n)
            upto[first + n - 1] = 2**32 - 1
            share[a:z] = np.minimum(upto, 2**32 - 1)
        by = np.argsort(dst, kind="stable")
        self._append((dst[by] + self.states).astype(U) << U(32) | share[by].astype(U), src[by] + self.states, piece[by])
        self.words.update(zip(words, (end + np.arange(len(words)) + self.states).tolist()))
        self.states += len(forward)

    def draw(self, texts: list[bytes], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts one after the other, and each text's number."""
        if self.edges > EDGES:
            self.clear()
        words, number = [], []
        for t in texts:
            own = WORDS.findall(b" " + t) if t else []
            number.append(len(own))
            words += own
        new = [w for w in dict.fromkeys(words) if w not in self.words]
        if new:
            self.add(new)
        state = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        first = state - np.fromiter(map(len, words), np.int64, len(words))
        number = np.array(number, np.int64)
        key, back, piece = self.key, self._back, self._piece
        text = np.repeat(np.arange(len(texts)), number)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
        own = mix(np.asarray(seeds, U)[text] + nth.astype(U) * U(0x9E3779B97F4A7C15))
        live, step = np.arange(len(text)), 0
        who, what = [], []
        while len(live):
            u = mix(own[live] + U((step + 1) * 0xD1342543DE82EF95 % 2**64)) >> U(32)
            at = np.searchsorted(key, (state[live].astype(U) << U(32)) + u)
            who.append(live)
            what.append(piece[at])
            state[live] = back[at]
            live = live[state[live] != first[live]]
            step += 1
        drawn = np.zeros(len(text), np.int64)
        for w in who:
            drawn[w] += 1
        last = np.cumsum(drawn) - 1
        ids = np.empty(int(drawn.sum()), np.int32)
        for k, (w, x) in enumerate(zip(who, what)):
            ids[last[w] - k] = x
        return ids, np.bincount(text, drawn, len(texts)).astype(np.int64)


def decode(ids: np.ndarray, raw: list[bytes]) -> bytes:
    """The text whose pieces are ``ids``."""
    return b"".join([raw[i] for i in ids.tolist()])[1:]


def _blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    at, size = 0, 0
    for i, n in enumerate(sizes):
        if i > at and size + n > BLOCK:
            yield at, i
            at, size = i, 0
        size += n
    if sizes:
        yield at, len(sizes)


def _encoded(model, theta: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(model.value, theta)
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            keys = mix(b.column("doc_id").to_numpy().astype(U) * U(0x9E3779B97F4A7C15) + U(seed))
            for at, z in _blocks(pc.binary_length(texts).to_pylist()):
                ids, n = lattice.draw(texts.slice(at, z - at).to_pylist(), keys[at:z])
                ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id").slice(at, z - at),
                                                  "ids": pa.ListArray.from_arrays(ends, ids)})
    return run


def _decoded(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = model.value
        for b in (x.slice(at, ROWS) for x in batches for at in range(0, x.num_rows, ROWS)):
            lists = b.column("ids")
            flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
            texts = [decode(flat[a:z], raw) for a, z in zip([0, *ends[:-1].tolist()], ends.tolist())]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "ids": lists,
                                              "text": pa.array(texts, pa.binary()).cast(pa.string())})
    return run


def encode(docs: DataFrame, path: str = MODEL, theta: float = THETA, seed: int = SEED) -> DataFrame:
    """doc_id, ids array<int>: one sampled segmentation of every whole text.
    The model (half a megabyte) is read by the driver, made a trie there and broadcast."""
    m = read_model(path)
    model = docs.sparkSession.sparkContext.broadcast({"trie": Trie(m["pieces"]), "bytes": m["bytes"]})
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                    or_empty().alias("text"))
    return d.mapInArrow(_encoded(model, theta, seed), "doc_id long, ids array<int>")


def decode_all(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, ids, text: the texts back from their pieces."""
    model = encoded.sparkSession.sparkContext.broadcast(read_model(path)["raw"])
    return encoded.select("doc_id", "ids").mapInArrow(_decoded(model), "doc_id long, ids array<int>, text string")
