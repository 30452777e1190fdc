"""BPE encoding and decoding by a tokenization automaton.

The merges are compiled, one after the other, into a deterministic automaton whose arcs are labelled
with tokens and which reads exactly the correct tokenizations. It starts with one state where every
byte loops. Merge r of u and v into w is a gadget on the states that u leads to: a copy of that state
without the arc v (no v may follow u any more) becomes the target of u, and w becomes a label of its
own that leads where v led, wherever u could be read. Since an arc's target depends on its label alone,
copies of copies form a tree of states; numbered from the root down, all states below a cut are an
interval. So the whole transition table is, for each label, a few intervals of states from which its
arc is missing: the states below a cut of the label itself, or of a token on its left side made before
the cut token was merged onwards.

Every prefix of a correct tokenization is correct, so all paths to a position of a word end in one
state. A word is read by its longest arcs first; a position from which no arc goes on is closed and
never entered again, so the work is linear. No merge is looked for and no pair is ranked while
encoding. Decoding emits the labels of the arcs.

Words are split as the tokenizer's file says (the byte-level rule); words that repeat are looked up in
a table of bounded size, which is emptied when it is full and changes no result. Each task compiles or
reuses its process's automaton from the file, so an executor that is lost costs nothing but its tasks.

Defined cases: a null or empty text has no tokens and decodes to an empty text; special tokens'
strings in a text are special tokens, as that library does; a word of any length is read in linear
time; documents are independent, so ties and repeated rows are rows of their own; a null id stays
null; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_column

#: The splitting rule of byte-level vocabularies (a fixed value).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
KNOWN, LONG, TABLE, FLUSH = 1 << 19, 64, 1 << 19, 1 << 20  # words kept and their length, transitions kept, tokens in an output batch


def byte_letters() -> dict[str, int]:
    """The visible letter that stands for each byte in a byte-level vocabulary."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Automaton:
    """labels: the bytes of each token (None for other ids); merges: (left, right, merged) ids in order of rank."""

    def __init__(self, labels: list[bytes | None], merges: list[tuple[int, int, int]]) -> None:
        self.labels = labels
        dead: set[int] = set()
        while found := self._compile([(r, *m) for r, m in enumerate(merges) if r not in dead]):
            dead |= found  # a merge that earlier ones leave nothing to do makes no gadget, and its token no arc
        self.table: dict[int, int] = {}
        self.sizes = [len(w or b"") for w in labels]
        self.longest = max(self.sizes)
        self.next: dict[int, int] = {}
        self.token_of = [-1]
        for t, label in enumerate(labels):
            if label is None or len(label) > 1 and t not in self.left:
                continue  # no arc has this label
            node = 0
            for b in label:
                key = node << 8 | b
                if key not in self.next:
                    self.next[key] = len(self.token_of)
                    self.token_of.append(-1)
                node = self.next[key]
            self.token_of[node] = t

    def _compile(self, merges: list[tuple[int, int, int, int]]) -> set[int]:
        """Gadget by gadget; returns the rank of the first merge, if any, whose arc was already missing."""
        state = [0] * len(self.labels)  # where each token leads
        parent, gadgets = [-1], {}
        self.left, self.made = {}, {}
        arcs = {t for t, label in enumerate(self.labels) if label is not None and len(label) == 1} | {w for *_, w in merges}
        if unmade := {r for r, u, v, _ in merges if u not in arcs or v not in arcs}:
            return unmade
        for r, u, v, w in merges:
            state[w] = state[v]  # before the cut: after w may come what may come after v
            parent.append(state[u])
            state[u] = len(parent) - 1
            gadgets.setdefault(v, []).append((state[u], r))
            self.left[w], self.made[w] = u, r
        children: list[list[int]] = [[] for _ in parent]
        for s, p in enumerate(parent[1:], 1):
            children[p].append(s)
        first, end, clock, stack = [0] * len(parent), [0] * len(parent), 0, [0]
        while stack:
            s = stack.pop()
            if s < 0:
                end[~s] = clock
                continue
            first[s] = clock
            clock += 1
            stack.append(~s)
            stack += children[s]
        self.number = [first[s] for s in state]
        self.cuts = {}
        for t, own in gadgets.items():
            rows = sorted((first[s], end[s], r) for s, r in own)
            for (_, b, q), (a, _, r) in zip(rows, rows[1:], strict=False):
                if a < b:  # the same arc was cut further up
                    return {max(q, r)}
            self.cuts[t] = tuple(map(list, zip(*rows, strict=True)))
        self.rows = {}
        late = [r for k, (r, _, v, _) in enumerate(merges, 1) if v in self.left and not self._has(first[parent[k]], self._row(v)[1:])]
        return {min(late)} if late else set()

    def _row(self, t: int) -> list:
        """The cuts that can take arc t from a state: those of t, and of its left side while that stood alone, as (begins, ends, ranks, last rank)."""
        row, limit, part = [], 1 << 40, t
        while True:
            if part in self.cuts:
                row.append((*self.cuts[part], limit))
            if part not in self.left:
                self.rows[t] = row
                return row
            limit, part = self.made[part], self.left[part]

    @staticmethod
    def _has(here: int, row: list) -> bool:
        """Whether a state lies below none of the cuts."""
        for begins, ends, ranks, limit in row:
            k = bisect_right(begins, here) - 1
            if k >= 0 and here < ends[k] and ranks[k] <= limit:
                return False
        return True

    def _go(self, key: int) -> int:
        """Fills in the transition table: where a state's arc leads, -1 if it has none; key is state << 32 | label."""
        here, t = key >> 32, key & 0xFFFFFFFF
        row = self.rows.get(t)
        to = self.number[t] if self._has(here, self._row(t) if row is None else row) else -1
        if len(self.table) >= TABLE:
            self.table.clear()
        self.table[key] = to
        return to

    def encode(self, word: bytes) -> list[int]:
        step, token_of, table, sizes, longest = self.next.get, self.token_of, self.table.get, self.sizes, self.longest
        n, closed, out, pending = len(word), set(), [], []  # positions that lead nowhere; (arc, its state); shorter arcs not yet tried
        at = here = 0
        while at < n:
            node, arcs = 0, []
            for b in word[at : at + longest]:
                node = step(node << 8 | b)
                if node is None:
                    break
                t = token_of[node]
                if t >= 0:
                    arcs.append(t)
            while True:
                if arcs:
                    t = arcs.pop()
                    to = table(key := here << 32 | t)
                    if to is None:
                        to = self._go(key)
                    if to >= 0 and at + sizes[t] not in closed:
                        break
                else:
                    closed.add(at)
                    if not out:
                        raise ValueError(f"the vocabulary has no tokens for {word[:40]!r}")
                    t, here = out.pop()
                    at -= sizes[t]
                    arcs = pending.pop()
            out.append((t, here))
            pending.append(arcs)
            at, here = at + sizes[t], to
        return [t for t, _ in out]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.labels.__getitem__, ids))


class Tokenizer:
    """A byte-level BPE file: special tokens, splitting, and the automaton for the words between."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or spec["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError("not a byte-level BPE file of the plain kind")
        if any(x[k] for x in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take in their surroundings are not supported")
        letters, vocab = byte_letters(), model["vocab"]
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        labels: list[bytes | None] = [None] * (1 + max([*vocab.values(), *special.values()]))
        for word, i in vocab.items():
            if word not in special:
                labels[i] = bytes(letters[c] for c in word)
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self._arcs = labels, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.labels = [w or b"" for w in labels]
        for word, i in special.items():
            self.labels[i] = word.encode()
        self._special = special
        self._between = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self._split = regex.compile(SPLIT)
        self._known: dict[str, bytes] = {}

    @cached_property
    def automaton(self) -> Automaton:
        """Compiled when a word is first encoded; decoding needs the labels alone."""
        return Automaton(*self._arcs)

    def _word(self, word: str) -> bytes:
        ids = np.array(self.automaton.encode(word.encode("utf-8")), "<i4").tobytes()
        if len(word) <= LONG:
            if len(self._known) >= KNOWN:
                self._known.clear()
            self._known[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers."""
        out = []
        known = self._known.get
        for part in self._between.split(text) if self._between else [text]:
            if part in self._special:
                out.append(np.array([self._special[part]], "<i4").tobytes())
            else:
                out += [known(w) or self._word(w) for w in self._split.findall(part)]
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.labels.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def _batch(ids: list, encoded: list[bytes], texts: list[str] | None) -> pa.RecordBatch:
    ends = np.cumsum([0, *(len(e) // 4 for e in encoded)]).astype(np.int32)
    values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(encoded))])
    columns = {"doc_id": pa.array(ids, pa.int64()), "ids": pa.ListArray.from_arrays(pa.array(ends), values)}
    return pa.RecordBatch.from_pydict(columns if texts is None else columns | {"text": pa.array(texts, pa.string())})


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """(doc_id, ids): the tokens of each document's whole text; with decode also the text that they spell, in the same task."""

    def run(batches):
        own = tokenizer(path)
        for batch in batches:
            names, texts = id_column(batch, "doc_id").to_pylist(), batch.column(1)
            ids, encoded, spelled, size = [], [], [] if decode else None, 0
            for doc, text in zip(names, texts, strict=True):
                ids.append(doc)
                encoded.append(own.encode(text.as_py() or ""))
                if decode:
                    spelled.append(own.decode(np.frombuffer(encoded[-1], "<i4")))
                size += len(encoded[-1])
                if size >= 4 * FLUSH:
                    yield _batch(ids, encoded, spelled)
                    ids, encoded, spelled, size = [], [], [] if decode else None, 0
            if ids:
                yield _batch(ids, encoded, spelled)

    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, ids array<int>" + ", text string" * decode)


def decode_documents(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text): the tokens and the text that their labels spell."""

    def run(batches):
        own = tokenizer(path)
        for batch in batches:
            column = batch.column(1)
            ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            texts = [own.decode(values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), column, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return tokens.mapInArrow(run, "doc_id long, ids array<int>, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded and decoded documents."""
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))
