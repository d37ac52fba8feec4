"""BPE encoding and decoding with a tokenization automaton.

The automaton reads tokens. It starts with one state that loops on every base
symbol; each merge (u, v), in order of rank, applies a gadget: where u leads to
a state with an arc v, an arc for the merged token is added beside u that leads
where v leads, and u is led to a copy of its state without the arc v. After all
merges the automaton accepts exactly the token sequences that applying the
merges would make, and it is deterministic. The state after a token depends on
that token alone, so a state is the token that leads to it, and the automaton is
a flat table of the arcs that gadgets left out: (u, v) and the rank of the merge.
The state of a merged token was copied from that of its right part, and an arc
for a merged token was added where its left part had one, so whether a state
has an arc is looked up for the parts in turn, down to the ranks that made them.

A word is encoded by one run over its symbols, the longest token first: an arc
is taken if the state reached has it, and given back if the run gets stuck. No
place is reached by two runs, so none is tried twice. The labels of the arcs of
the run are the tokens; decoding emits the labels.

The vocabulary file is read where the plan is made and sent to the tasks (its
size is that of the vocabulary); tasks need no file.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut, fresh

#: white space of the file's patterns (fixed value)
SPACE = r"\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: words and arcs kept per task, and bytes or ids per output batch
CACHED_WORDS, CACHED_ARCS = 150_000, 200_000
BATCH_SIZE = 1_000_000
#: the split into words of the file (fixed value), and its faster equal for ASCII in lower case
KNOWN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_SPLIT = re.compile(r"[a-z]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\t\n\v\f\r a-z0-9]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    printable in Latin-1, else the next unused one from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Automaton:
    """Tokenization automaton of a vocabulary (token to id), its merges in
    order of rank and the suffix that marks the last symbol of a word."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        size = max(vocab.values()) + 1
        self.left, self.right, self.made = [-1] * size, [-1] * size, [-1] * size
        self.removed: dict[int, dict[int, int]] = {}  # of a state, the arcs left out and the ranks of their merges
        self.last = len(merges) + 1
        live, texts = [True] * size, {}  # a symbol is one character: a byte, or 256 + the last byte of a word
        for byte, mark in enumerate(byte_symbols()):
            if mark + suffix in vocab:
                texts[vocab[mark + suffix]] = chr(256 + byte)
            if mark in vocab:
                texts[vocab[mark]] = chr(byte)
        self.gaps = {c for b in range(256) for c in (chr(b), chr(256 + b))} - set(texts.values())
        self.marks = bool(suffix)
        for rank, (a, b) in enumerate(merges):
            u, v, uv = vocab[a], vocab[b], vocab[a + b]
            if uv in texts:
                raise ValueError(f"token {uv} is made twice")
            texts[uv] = texts[u] + texts[v]
            live[uv] = live[u] and live[v] and self.has_arc(u, v)
            self.left[uv], self.right[uv], self.made[uv] = u, v, rank
            if live[uv]:
                self.removed.setdefault(u, {})[v] = rank
        #: tokens that can occur by their symbols, and the longest by the first three
        self.tokens = {text: t for t, text in texts.items() if live[t]}
        self.longest: dict[str, int] = {}
        for text in self.tokens:
            if len(text) > 2:
                self.longest[text[:3]] = max(len(text), self.longest.get(text[:3], 3))

    def has_arc(self, state: int, token: int) -> bool:
        """Whether the state after token ``state`` has an arc ``token``: no
        merge of what they were made of came before what they became. Of equal
        ranks the merge further left comes first."""
        left, right, made, removed, before = self.left, self.right, self.made, self.removed, self.last
        while True:
            gone = removed.get(state)
            if gone is not None and gone.get(token, before) < before:
                return False
            a, b = made[state], made[token]
            if a > b:
                before, state = a, right[state]
            elif b >= 0:
                before, token = b + 1, left[token]
            else:
                return True

    def encode(self, word: bytes, arcs: dict[int, bool]) -> list[int]:
        """Tokens of one word; ``arcs`` is the table of arcs looked up so far."""
        symbols = word.decode("latin-1")
        if self.marks:
            symbols = symbols[:-1] + chr(256 + word[-1])
        if not self.gaps.isdisjoint(symbols):  # bytes that the vocabulary lacks are left out
            symbols = "".join(s for s in symbols if s not in self.gaps)
        n, size = len(symbols), len(self.made)
        tokens, longest, known = self.tokens.get, self.longest.get, arcs.get
        out: list[int] = []
        starts: list[int] = []
        at, state = 0, -1
        to = min(longest(symbols[:3], 2), n)
        while at < n:
            while to > at:
                token = tokens(symbols[at:to])
                if token is not None:
                    if state < 0:
                        break
                    ok = known(state * size + token)
                    if ok is None:
                        ok = arcs[state * size + token] = self.has_arc(state, token)
                    if ok:
                        break
                to -= 1
            if to > at:
                out.append(token)
                starts.append(at)
                at, state = to, token
                to = at + longest(symbols[at:at + 3], 2)
                if to > n:
                    to = n
            else:  # stuck: the last arc is given back for a shorter one
                to = at - 1
                at = starts.pop()
                out.pop()
                state = out[-1] if out else -1
        return out


class Tokenizer:
    """What the vocabulary file says: special tokens, then composed form and
    lower case, then the split into words, then the automaton."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = model["vocab"] | self.special
        self.labels = np.full(max(names.values()) + 1, None, object)
        for name, i in names.items():
            self.labels[i] = name
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]

    def worker(self) -> Worker:
        return Worker(self)


class Worker:
    """A tokenizer in a task, with tables of bounded size for words and arcs."""

    def __init__(self, tokenizer: Tokenizer):
        import regex

        class Words(dict):
            """Words met lately; when full, they become the words met before
            and only those that come again are taken over."""
            before: dict = {}

            def __missing__(words, word):
                if len(words) >= CACHED_WORDS:
                    words.before = dict(words)
                    words.clear()
                if len(self.arcs) >= CACHED_ARCS:  # the older half goes
                    for key in list(islice(self.arcs, CACHED_ARCS // 2)):
                        del self.arcs[key]
                ids = words.before.get(word)
                if ids is None:
                    ids = array("i", tokenizer.automaton.encode(word.encode(), self.arcs)).tobytes()
                words[word] = ids
                return ids

        self.tokenizer, self.arcs, self.words = tokenizer, {}, Words()
        self.split = self.split_ascii = regex.compile(tokenizer.pattern.replace(r"\s", SPACE)).findall
        if tokenizer.pattern == KNOWN_SPLIT:
            self.split_ascii = ASCII_SPLIT.findall
        names = sorted(tokenizer.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None

    def encode(self, text: str) -> np.ndarray:
        special = self.tokenizer.special
        if self.special is None or not any(s in text for s in special):
            return np.frombuffer(self._plain(text), np.int32)
        parts = [np.int32(special[part]).tobytes() if part in special else self._plain(part) for part in self.special(text)]
        return np.frombuffer(b"".join(parts), np.int32)

    def _plain(self, text: str) -> bytes:
        if text.isascii():
            return b"".join(map(self.words.__getitem__, self.split_ascii(text.lower())))
        text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")  # lower case letter by letter
        return b"".join(map(self.words.__getitem__, self.split(text.lower())))


def joined(labels: np.ndarray, ids: np.ndarray) -> str:
    """Labels of the arcs joined by a space, as the file names no decoder; ids
    that it does not know are left out."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(labels)):
        ids = ids[(ids >= 0) & (ids < len(labels))]
    found = labels[ids].tolist()
    return " ".join(found if None not in found else [t for t in found if t is not None])


def _replace(names: list[str], make):
    """A mapInArrow function that puts columns ``names`` in the place of the
    last column, a few rows at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        convert = make()
        for batch in batches:
            col = batch.column(batch.num_columns - 1)
            size = pc.list_value_length if pa.types.is_list(col.type) else pc.binary_length
            sizes = np.asarray(size(col).fill_null(0))
            for part in cut(batch, sizes, BATCH_SIZE):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *convert(part.column(part.num_columns - 1))],
                    [*part.schema.names[:-1], *names])
    return run


def encode(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "ids",
           decoded_col: str | None = None) -> DataFrame:
    """``docs`` with ``text_col`` replaced by ``out_col`` (array<int>) and,
    where named, ``decoded_col``: what these ids decode to, in the same pass.

    Null and empty texts and texts of white space have no ids; a text of any
    length is one row, encoded in one go (time and memory grow with its
    length). Other columns, repeated rows and the order in a partition stay.
    Columns of the old frame with the new names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Tokenizer(path))
    new = [out_col, *([decoded_col] if decoded_col else [])]

    def make():
        worker = shared.value.worker()
        labels = shared.value.labels

        def convert(col):
            found = [worker.encode(t or "") for t in col.to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            ids = pa.ListArray.from_arrays(offsets, np.concatenate([*found, np.empty(0, np.int32)]))
            return [ids, pa.array([joined(labels, x) for x in found], pa.string())][:len(new)]
        return convert

    kept = [c for c in docs.columns if c not in (text_col, *new)]
    rows = docs.select(*kept, F.col(text_col).cast("string"))
    kinds = [F.lit(None).cast(k).alias(n) for n, k in zip(new, ("array<int>", "string"), strict=False)]
    return rows.mapInArrow(_replace(new, make), rows.select(*kept, *kinds).schema)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``rows`` with ``out_col``, the labels of ``ids_col`` joined by spaces,
    as last column. Null ids give an empty text; unknown ids are left out."""
    shared = rows.sparkSession.sparkContext.broadcast(Tokenizer(path).labels)

    def make():
        labels = shared.value

        def convert(col):
            ids = col.values.to_numpy(zero_copy_only=False)  # of all rows; a null list has no extent
            if col.values.null_count:
                ids = col.values.fill_null(-1).to_numpy()
            ends = col.offsets.to_numpy()
            return [pa.array([joined(labels, ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())]
        return convert

    kept = [c for c in rows.columns if c != out_col]
    plan = rows.select(*kept, F.col(ids_col).cast("array<int>").alias(fresh(rows, "coded")[0]))
    schema = rows.select(*kept, F.lit(None).cast("string").alias(out_col)).schema
    return plan.mapInArrow(_replace([out_col], make), schema)
