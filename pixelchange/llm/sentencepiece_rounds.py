"""SentencePiece BPE by vectorised merge rounds, and decoding.

A batch's texts are cut into words at places that no piece can span: between
two characters that are neighbours in no piece.  The distinct words are laid
out as one flat numpy array of symbols.  A round looks up the rank of each
pair of neighbours, takes the least rank in every word, merges the leftmost
pairs of that rank in all words at once and compacts the array; words
without a pair leave it.  The library merges one pair after another, best rank
first, leftmost first; all pairs of the least rank that don't overlap can be
merged in the same round if the new piece is part of no pair of a better rank
(``alone`` tells); else a round merges the leftmost of them only.  So the ids
are the same.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelchange.llm.common import slices, strings, utf8_bytes

BLANK = "▁"


def read_model(path: str) -> dict:
    """Pieces of a model file: texts, scores, and what the encoder needs of its settings."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    plain = [not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i)) for i in range(n)]
    pieces = [sp.id_to_piece(i) for i in range(n)]
    # Settings that the encoder relies on, seen from outside.
    for text in ("a", " a", "a  b ", "é ﬁ", "　a"):
        if sp.decode(sp.encode(text)) != text:
            raise ValueError("only models with an identity normaliser, a leading blank and byte fallback are supported")
    if any(BLANK in p.lstrip(BLANK) for p, ok in zip(pieces, plain) if ok):
        raise ValueError("pieces that span words are not supported")
    byte_id = {int(p[3:5], 16): i for i, p in enumerate(pieces) if sp.is_byte(i)}
    if len(byte_id) != 256:
        raise ValueError("the model has no byte fallback")
    return {"pieces": pieces, "scores": [sp.get_score(i) for i in range(n)], "plain": plain,
            "bytes": [byte_id[b] for b in range(256)]}


class Codec:
    """Lookup tables of a model, built once a task."""

    def __init__(self, model: dict):
        pieces, plain = model["pieces"], model["plain"]
        self.bytes = model["bytes"]
        self.surface = [p.replace(BLANK, " ").encode() if ok else b"" for p, ok in zip(pieces, plain)]
        for value, i in enumerate(self.bytes):
            self.surface[i] = bytes([value])
        self.symbol = {p: i for i, (p, ok) in enumerate(zip(pieces, plain)) if ok}
        # Characters inside pieces that are no piece themselves get symbols too.
        self.first_extra = len(pieces)
        longer = [p for p in self.symbol if len(p) > 1]
        for p in longer:
            for c in p:
                self.symbol.setdefault(c, self.first_extra + len(self.symbol))
        self.other = max(self.symbol.values()) + 1          # characters that no piece has
        self.width = self.other + 1
        rank_of = {s: r for r, s in enumerate(sorted({model["scores"][self.symbol[p]] for p in longer}, reverse=True))}
        keys, ranks, made = [], [], []
        for p in longer:
            for cut in range(1, len(p)):
                a, b = self.symbol.get(p[:cut]), self.symbol.get(p[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.width + b)
                    ranks.append(rank_of[model["scores"][self.symbol[p]]])
                    made.append(self.symbol[p])
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.ranks = np.array(ranks, np.int64)[order]
        self.made = np.array(made, np.int64)[order]
        self.none = len(rank_of)
        # Pieces that are made after all pairs that hold them can be merged at all places at once.
        best = np.full(self.width, self.none, np.int64)
        left, right = self.keys // self.width, self.keys % self.width
        np.minimum.at(best, left, self.ranks)
        np.minimum.at(best, right, self.ranks)
        self.alone = best[self.made] > self.ranks
        # Neighbours inside pieces: no word is cut between them.
        inner = sorted({c for p in longer for c in p})
        self.kind = np.zeros(0x110000, np.uint16)
        self.kind[[ord(c) for c in inner]] = np.arange(1, len(inner) + 1)
        self.kind[0x20] = self.kind[ord(BLANK)]
        self.joined = np.zeros((len(inner) + 1, len(inner) + 1), bool)
        for p in longer:
            k = self.kind[[ord(c) for c in p]]
            self.joined[k[:-1], k[1:]] = True
        # Symbol of each character, and of each id its decimal text with a comma and its bytes.
        self.symbol_of = np.full(0x110000, self.other, np.int64)
        for p, i in self.symbol.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i
        self.symbol_of[0x20] = self.symbol_of[ord(BLANK)]
        self.id_text = pa.array([b"%d," % i for i in range(len(pieces))], pa.large_binary())
        self.id_bytes = pa.array(self.surface, pa.large_binary())

    def _pairs(self, left, right):
        """Rank of pairs of symbols, and where their merge is listed."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none), at

    def merge_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all words, one word after another, and the words' offsets in them."""
        data, _ = utf8_bytes(words)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        symbols, place = self.symbol_of[points], np.arange(len(points))
        word = np.repeat(np.arange(len(words)), pc.utf8_length(words).to_numpy())
        done: list[tuple] = []
        rank, merge = np.full(len(symbols), self.none, np.int64), np.zeros(len(symbols), np.int64)
        self._refresh(symbols, word, rank, merge, np.arange(len(symbols)))
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(starts, len(word)))
            least = np.minimum.reduceat(rank, starts)
            live = least < self.none
            if not live.all():
                stay = np.repeat(live, size)
                done.append((word[~stay], symbols[~stay], place[~stay]))
                symbols, word, place, rank, merge = symbols[stay], word[stay], place[stay], rank[stay], merge[stay]
                if not len(symbols):
                    break
                size, least = size[live], least[live]
            hits = np.flatnonzero(rank == np.repeat(least, size))
            chosen = hits[self._together(hits, word[hits], merge[hits])]
            symbols[chosen] = self.made[merge[chosen]]
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            moved = np.cumsum(keep) - 1
            symbols, word, place, rank, merge = symbols[keep], word[keep], place[keep], rank[keep], merge[keep]
            at = moved[chosen]
            self._refresh(symbols, word, rank, merge, np.concatenate([at, at[at > 0] - 1]))
        if not done:
            return symbols, np.zeros(len(words) + 1, np.int64)
        word, symbols, place = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        word, ids, place = word[order], symbols[order], points[place[order]]
        odd = np.flatnonzero(ids >= self.first_extra)          # characters without a piece become bytes
        if len(odd):
            own = [chr(c if c != 0x20 else ord(BLANK)).encode() for c in place[odd]]
            many = np.ones(len(ids), np.int64)
            many[odd] = [len(b) for b in own]
            first = np.cumsum(many) - many
            ids, word = np.repeat(ids, many), np.repeat(word, many)
            for at, raw in zip(first[odd], own):
                ids[at:at + len(raw)] = [self.bytes[b] for b in raw]
        return ids, np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(words)))])

    def _together(self, hits, word, merge) -> np.ndarray:
        """Which of the least pairs of each word a round merges: the leftmost and, where
        that changes nothing for the others, every second one of a run of overlaps."""
        first = np.concatenate([[True], word[1:] != word[:-1]])
        at = np.arange(len(hits))
        run = np.concatenate([[True], hits[1:] != hits[:-1] + 1]) | first
        even = (at - np.maximum.accumulate(np.where(run, at, 0))) % 2 == 0
        starts = np.flatnonzero(first)
        free = np.logical_and.reduceat(self.alone[merge], starts)
        return first | (even & np.repeat(free, np.diff(np.append(starts, len(hits)))))

    def _refresh(self, symbols, word, rank, merge, at):
        """Rank anew the pairs that start at ``at``."""
        last = at == len(symbols) - 1
        rank[at[last]] = self.none
        at = at[~last]
        r, m = self._pairs(symbols[at], symbols[at + 1])
        rank[at] = np.where(word[at] == word[at + 1], r, self.none)
        merge[at] = m

    def words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Words of all texts, one after another, and the offsets of each text's words.
        A text begins with a blank; an empty one has no words."""
        led = pc.binary_join_element_wise("", texts, " ")
        texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", led).cast(pa.large_string())
        data, at = utf8_bytes(texts)
        if not len(data):
            return pa.array([], pa.large_string()), np.zeros(len(texts) + 1, np.int64)
        kind = self.kind[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)]
        begins = np.flatnonzero((data & 0xC0) != 0x80)          # first bytes of characters
        cut = np.concatenate([[True], ~self.joined[kind[:-1], kind[1:]]])
        cut[np.searchsorted(begins, at[:-1][np.diff(at) > 0])] = True
        ends = np.append(begins[cut], len(data))
        words = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])
        return words, np.searchsorted(ends, at)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the texts' offsets in them."""
        words, at = self.words(texts)
        coded = words.dictionary_encode()
        ids, begin = self.merge_words(coded.dictionary)
        word = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(np.diff(begin)[word])])
        # places in ids, word after word
        places = np.arange(ends[-1]) + np.repeat(begin[word] - ends[:-1], np.diff(ends))
        return ids[places], ends[at]

    def joined_as(self, form: pa.Array, ids: np.ndarray, at: np.ndarray) -> tuple[memoryview, list[int]]:
        """``form`` of all ids in one buffer, and the texts' offsets in it."""
        data, ends = utf8_bytes(form.take(pa.array(ids)))
        return memoryview(data), ends[at].tolist()

    def encode(self, texts: list[str]) -> list[list[int]]:
        ids, at = self.encode_all(pa.array(texts, pa.string()))
        return [ids[a:b].tolist() for a, b in zip(at, at[1:])]

    def decode(self, ids: list[int]) -> str:
        """Text of ids, without the blank that encoding puts before a text."""
        raw = b"".join(self.surface[i] for i in ids)
        return (raw[1:] if raw[:1] == b" " else raw).decode(errors="replace")


def codec(docs: DataFrame, model_path: str):
    """The model's tables as a broadcast (bounded by its vocabulary)."""
    return docs.sparkSession.sparkContext.broadcast(read_model(model_path))


def encode_documents(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """``key``, ``n_tokens``, ``ids_sha256`` (of decimal ids joined by commas) and
    ``decoded_sha256`` (of the decoded text) of each row and, ``with_ids``, the ids.

    A null text is empty; an empty text has no ids and decodes to an empty
    text; equal rows give equal rows; other columns are ignored."""
    shared = codec(docs, model_path)
    kept = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))

    def run(batches):
        own = Codec(shared.value)
        for batch in batches:
            for part in slices(batch, "_text"):
                ids, at = own.encode_all(strings(part.column(1)))
                (id_text, id_at), (raw, raw_at) = own.joined_as(own.id_text, ids, at), own.joined_as(own.id_bytes, ids, at)
                # ids are joined by commas, of which the last is none; the blank before a text is no part of it
                id_digests = [hashlib.sha256(id_text[a:max(a, b - 1)]).hexdigest() for a, b in zip(id_at, id_at[1:])]
                text_digests = [hashlib.sha256(raw[a + (raw[a:a + 1] == b" "):b] if b > a else b"").hexdigest() for a, b in zip(raw_at, raw_at[1:])]
                columns = [part.column(0), pa.array(np.diff(at)), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=[key, "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(columns)])

    kind = kept.schema["_key"].dataType.simpleString()
    return kept.mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def decode_documents(rows: DataFrame, model_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and the text of each row's ids (null: none)."""
    shared = codec(rows, model_path)
    kept = rows.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{ids}`").cast("array<int>").alias("_ids"))

    def run(batches):
        own = Codec(shared.value)
        for batch in batches:
            texts = [own.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "decoded"])

    return kept.mapInArrow(run, f"`{key}` {kept.schema['_key'].dataType.simpleString()}, decoded string")
