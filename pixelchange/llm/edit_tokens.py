"""Token counts that follow edits.

A document's pre-tokens are cut into segments; a segment tree over them
holds characters and tokens of each subtree (two arrays, children of node i
at 2i and 2i+1).  Edits descend the tree to the segments that they touch;
edits whose regions meet are one region.  A region and as much context as the
pre-tokenizer's boundaries need is encoded anew, cut into segments of the usual
size, and the sums above are updated.  All other segments keep their counts, and
the new text is put together once, so the work is in the edits and what they
touch, however many there are.

Pre-tokens are found from left to right and depend only on the text from
their start on, so a boundary after a letter or digit, before the edit, stays;
behind the edit, encoding ends as soon as it meets an old segment boundary.
"""

from __future__ import annotations

import base64
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelchange.llm.common import slices

SEGMENT = 32                # pre-tokens of a segment
CACHED = 200_000            # pre-tokens whose counts a task keeps (memory only)

# How the byte-level vocabulary splits text before its merges.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Spans that ``redactions`` masks: e-mail addresses, IPv4 addresses, long numbers.
PERSONAL = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "<EMAIL>"),
            (r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])", "<IP>"),
            (r"(?<!\d)\d{13,19}(?!\d)", "<NUMBER>")]


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary file: a token in base 64 and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Counter:
    """Tokens of pre-tokens, with a memory of those seen."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.encoding = tiktoken.Encoding("counts", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(PRE_TOKEN)
        self.known: dict[str, int] = {}

    def tokens(self, pre: str) -> int:
        n = self.known.get(pre)
        if n is None:
            if len(self.known) >= CACHED:
                self.known = {}
            n = self.known[pre] = len(self.encoding.encode_ordinary(pre))
        return n

    def tree(self, text: str) -> "Tree":
        pres = self.pattern.findall(text)
        chars = [len(p) for p in pres]
        counts = [self.tokens(p) for p in pres]
        cuts = range(0, len(pres), SEGMENT)
        return Tree.build([sum(chars[i:i + SEGMENT]) for i in cuts], [sum(counts[i:i + SEGMENT]) for i in cuts])

    def edit(self, text: str, tree: "Tree", start: int, end: int, by: str) -> tuple[str, int]:
        """Replace ``text[start:end]`` and bring the tree up to date; the new text
        and the number of characters encoded anew."""
        return self.edit_all(text, tree, [(start, end, by)])

    def edit_all(self, text: str, tree: "Tree", edits: list[tuple[int, int, str]]) -> tuple[str, int]:
        """Apply edits that are in order and don't overlap (``disjoint``)."""
        pieces, at = [], 0
        for start, end, by in edits:
            pieces += [text[at:start], by]
            at = end
        new = "".join(pieces) + text[at:]
        chars, tokens = tree.leaves()
        begin = [0, *accumulate(chars)]                     # old places of the segments
        out_chars, out_tokens, kept, shift, anew, e = [], [], 0, 0, 0, 0
        while e < len(edits):
            first = self._region(text, tree, begin, edits[e][0])
            out_chars += chars[kept:first]
            out_tokens += tokens[kept:first]
            at = pos = begin[first] + shift
            sizes, counts, last, more = [], [], first, True
            while more:
                start, end, by = edits[e]
                e += 1
                shift += len(by) - (end - start)
                last = max(last, tree.find(max(end - 1, start, 0))[0])
                behind = end + shift                        # new place of what follows the edit
                following = begin[self._region(text, tree, begin, edits[e][0])] if e < len(edits) else None
                more = False
                while pos < len(new):
                    # old boundaries behind the edit that the scan has passed belong to the region
                    while last + 1 < tree.n and pos - shift > begin[last + 1]:
                        last += 1
                    stop = begin[last + 1]
                    if following is not None and (following < stop or pos - shift >= edits[e][0]):
                        more = True                         # the next edit's region begins in this one
                        break
                    if pos - shift == stop and stop >= end and pos >= behind and pos > at:
                        break
                    pre = self.pattern.match(new, pos).group()
                    sizes.append(len(pre))
                    counts.append(self.tokens(pre))
                    pos += len(pre)
                else:
                    more = e < len(edits)
                    last = tree.n - 1 if not more else last
            anew += pos - at
            for a in range(0, len(sizes), SEGMENT):
                out_chars.append(sum(sizes[a:a + SEGMENT]))
                out_tokens.append(sum(counts[a:a + SEGMENT]))
            kept = last + 1
        tree.renew(out_chars + chars[kept:], out_tokens + tokens[kept:])
        return new, anew

    def _region(self, text: str, tree: "Tree", begin: list[int], start: int) -> int:
        """Segment at which the region of an edit begins: its start is a boundary that
        the edit can't move."""
        first = tree.find(max(start - 1, 0))[0]
        while first > 0 and not (begin[first] < start and text[begin[first] - 1].isalnum()):
            first -= 1
        return first


class Tree:
    """Segment tree of character and token counts."""

    def __init__(self, chars: list[int], tokens: list[int], n: int):
        self.chars, self.tokens, self.n = chars, tokens, n
        self.size = len(chars) // 2

    @classmethod
    def build(cls, chars: list[int], tokens: list[int]) -> "Tree":
        size = 1
        while size < len(chars):
            size *= 2
        out = []
        for leaves in (chars, tokens):
            nodes = [0] * size + leaves + [0] * (size - len(leaves))
            for i in range(size - 1, 0, -1):
                nodes[i] = nodes[2 * i] + nodes[2 * i + 1]
            out.append(nodes)
        return cls(out[0], out[1], max(len(chars), 1))

    def total(self) -> int:
        return self.tokens[1]

    def find(self, position: int) -> tuple[int, int]:
        """Segment that holds a character (the last one behind the end) and where it starts."""
        node, start = 1, 0
        if position >= self.chars[1]:
            position = max(self.chars[1] - 1, 0)
        while node < self.size:
            node *= 2
            if position - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - self.size, start

    def leaves(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of the segments."""
        return list(self.chars[self.size:self.size + self.n]), list(self.tokens[self.size:self.size + self.n])

    def renew(self, chars: list[int], tokens: list[int]) -> None:
        """Other segments; all sums above them follow."""
        new = Tree.build(chars, tokens)
        self.chars, self.tokens, self.n, self.size = new.chars, new.tokens, new.n, new.size


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits that mask personal data and take out lines equal to an earlier line."""
    found, seen, at = [], set(), 0
    for line in text.split("\n"):
        end = at + len(line)
        if line.strip() and line in seen:
            found.append((at, min(end + 1, len(text)), ""))
        else:
            seen.add(line)
            for pattern, mark in _PERSONAL:
                found.extend((at + m.start(), at + m.end(), mark) for m in pattern.finditer(line))
        at = end + 1
    return disjoint(found, len(text))


_PERSONAL = [(regex.compile(p), mark) for p, mark in PERSONAL]


def disjoint(edits, length: int) -> list[tuple[int, int, str]]:
    """Edits in order of their start, clipped to the text and to the start of the next.

    Of edits with the same place all are kept, in the order given, as insertions
    but for the last."""
    out = []
    for start, end, by in sorted(((min(max(a, 0), length), min(max(b, 0), length), t or "") for a, b, t in edits), key=lambda e: e[0]):
        if out and out[-1][1] > start:
            out[-1] = (out[-1][0], start, out[-1][2])
        out.append((start, max(start, end), by))
    return out


TREE = "chars array<int>, tokens array<int>, segments int"


def build_trees(docs: DataFrame, ranks_path: str, edits_of=None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``text``, the tree's arrays and, with ``edits_of`` (text to edits), ``edits``.

    A null or empty text has one empty segment."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))

    def run(batches):
        counter = Counter(shared.value)
        for batch in batches:
            for part in slices(batch, "_text"):
                texts = [t or "" for t in part.column(1).to_pylist()]
                trees = [counter.tree(t) for t in texts]
                arrays = [part.column(0), pa.array(texts, pa.string()), pa.array([t.chars for t in trees], pa.list_(pa.int32())),
                          pa.array([t.tokens for t in trees], pa.list_(pa.int32())), pa.array([t.n for t in trees], pa.int32())]
                if edits_of is not None:
                    found = [[{"start": a, "end": b, "by": t} for a, b, t in edits_of(x)] for x in texts]
                    arrays.append(pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("by", pa.string())]))))
                yield pa.RecordBatch.from_arrays(arrays, names=[key, text, "chars", "tokens", "segments", "edits"][:len(arrays)])

    schema = f"`{key}` {kept.schema['_key'].dataType.simpleString()}, `{text}` string, {TREE}"
    if edits_of is not None:
        schema += ", edits array<struct<start:int,end:int,by:string>>"
    return kept.mapInArrow(run, schema)


def apply_edits(rows: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of each row of ``build_trees`` after its ``edits``.

    Edits are of the text as it is stored.  Overlaps are clipped (``disjoint``);
    null edits are none; repeated rows give repeated rows; other columns are
    ignored.  Returns the new text, the new tree, tokens before
    and after, the number of edits and of characters encoded anew."""
    shared = rows.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept = rows.select(F.col(key).alias("_key"), F.col(text).alias("_text"), "chars", "tokens", "segments", "edits")

    def run(batches):
        counter = Counter(shared.value)
        for batch in batches:
            for part in slices(batch, "_text"):
                out = {k: [] for k in ("text", "chars", "tokens", "segments", "before", "after", "edits", "anew")}
                for body, chars, tokens, n, edits in zip(*(part.column(i).to_pylist() for i in range(1, 6))):
                    tree = Tree(chars, tokens, n)
                    out["before"].append(tree.total())
                    todo = disjoint([(e["start"], e["end"], e["by"]) for e in edits or [] if e is not None], len(body))
                    body, anew = counter.edit_all(body, tree, todo)
                    for name, value in (("text", body), ("chars", tree.chars), ("tokens", tree.tokens), ("segments", tree.n), ("after", tree.total()),
                                        ("edits", len(todo)), ("anew", anew)):
                        out[name].append(value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(out["text"], pa.string()), pa.array(out["chars"], pa.list_(pa.int32())),
                     pa.array(out["tokens"], pa.list_(pa.int32())), pa.array(out["segments"], pa.int32()), pa.array(out["before"], pa.int64()),
                     pa.array(out["after"], pa.int64()), pa.array(out["edits"], pa.int64()), pa.array(out["anew"], pa.int64())],
                    names=[key, text, "chars", "tokens", "segments", "n_tokens_before", "n_tokens", "n_edits", "n_chars_anew"])

    kind = kept.schema["_key"].dataType.simpleString()
    return kept.mapInArrow(run, f"`{key}` {kind}, `{text}` string, {TREE}, n_tokens_before long, n_tokens long, n_edits long, n_chars_anew long")


def op5_token_counts(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Tokens of every document before and after masking personal data and
    taking out repeated lines."""
    edited = apply_edits(build_trees(docs, ranks_path, redactions), ranks_path)
    return edited.select("doc_id", "n_tokens_before", "n_edits", "n_tokens", "n_chars_anew", "segments",
                         F.sha2("text", 256).alias("text_sha256"))
