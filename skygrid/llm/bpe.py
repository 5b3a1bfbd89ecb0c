"""BPE encoding and decoding by speculation (operator 13).

A word is first cut greedily into the longest tokens. The cut is the exact encoding if every token
is (a token encodes to itself) and no two neighbours would ever have merged across their border. The
second is checked for all neighbours of a batch at once: both tokens are taken apart step by step,
latest merge first, and the two pieces that touch at each moment are looked up among the merges. Only
words with a pair that fails are merged one by one.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skygrid.llm.common import small_batches, worker_state

#: Pieces of text a worker keeps; about 200 bytes each.
KEPT = 1_000_000
#: Longer words are merged with a heap.
LONG_WORD = 100
#: Between words; no byte of a word.
BREAK = "\uffff"
NEVER = np.iinfo(np.int64).max


def byte_alphabet() -> dict[str, int]:
    """The byte that each letter of the byte-level alphabet stands for.

    Printable Latin-1 bytes stand for themselves, the others for code points from 256 on, in order.
    """
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """A vocabulary's tokens as bytes and its merges as arrays over token ids."""

    def __init__(self, tokens: dict[int, bytes], merges: list[tuple[bytes, bytes]]):
        ids = {b: i for i, b in tokens.items()}
        size = max(tokens) + 1
        self.tokens, self.ids = tokens, ids
        self.rank = np.full(size, -1, np.int64)  # of the merge that makes a token; -1: a byte
        self.left, self.right = np.arange(size), np.arange(size)
        self.rank_by_key: dict[int, int] = {}  # by left id * size + right id
        self.made: list[int] = []  # by rank
        ordered = True
        for rank, (a, b) in enumerate(merges):
            a, b, c = ids[a], ids[b], ids[a + b]
            self.rank_by_key.setdefault(a * size + b, rank)
            self.made.append(c)
            ordered &= self.rank[c] < 0 and len(tokens[c]) > 1 and all(len(tokens[x]) == 1 or self.rank[x] >= 0 for x in (a, b))
            self.rank[c], self.left[c], self.right[c] = rank, a, b
        keys = np.array(list(self.rank_by_key) or [-1], np.int64)
        ranks = np.array(list(self.rank_by_key.values()) or [NEVER], np.int64)
        order = np.argsort(keys)
        self.size, self._keys, self._ranks = size, keys[order], ranks[order]
        #: Speculation needs one merge per token, made after its parts; else all words are merged.
        self.ordered = ordered

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of a and b, NEVER if there is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self._keys, key), self._keys.size - 1)
        return np.where(self._keys[at] == key, self._ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether bytes of a and b side by side are never merged across their border.

        ``until``: only merges of lower rank count (all, if not given). ``x`` is the end of a and
        ``y`` the start of b at a moment; they last until the merges of rank ``x_end`` and ``y_end``
        swallow them. They would have merged if their own merge comes before both. Equal merges
        happen from the left: one that swallows x comes first, one that swallows y does not.
        """
        x, y = a.astype(np.int64), b.astype(np.int64)
        x_end = np.full(x.size, NEVER) if until is None else until.astype(np.int64)
        y_end = x_end.copy()
        out, live = np.ones(x.size, bool), np.arange(x.size)
        while live.size:
            r = self.rank_of(x, y)
            crossed = (r < x_end) & (r <= y_end)
            out[live[crossed]] = False
            x_made, y_made = self.rank[x], self.rank[y]
            more = ~crossed & ((x_made >= 0) | (y_made >= 0))
            undo_x = x_made > y_made  # of equal merges, the right one is the later
            x_end, y_end = np.where(undo_x, x_made, x_end)[more], np.where(undo_x, y_end, y_made)[more]
            x, y = np.where(undo_x, self.right[x], x)[more], np.where(undo_x, y, self.left[y])[more]
            live = live[more]
        return out

    @cached_property
    def whole(self) -> dict[bytes, int]:
        """Tokens whose bytes encode to the token itself."""
        made = np.array([i for i in self.tokens if self.rank[i] >= 0], np.int64)
        fits = np.ones(self.size, bool)
        fits[made] = self.compatible(self.left[made], self.right[made], self.rank[made])
        for i in made[np.argsort(self.rank[made])]:  # parts come before the whole
            fits[i] &= fits[self.left[i]] & fits[self.right[i]]
        return {b: i for i, b in self.tokens.items() if fits[i]}

    @cached_property
    def _automaton(self):
        """Finds the longest token at each place of many words at once; BREAK stands between words."""
        import ahocorasick

        out = ahocorasick.Automaton()
        for b, i in self.whole.items():
            out.add_word(b.decode("latin-1"), i)
        out.add_word(BREAK, -1)
        out.make_automaton()
        return out

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The longest token at each place, from the left: (word's number, id) of every token."""
        text = BREAK.join(w.decode("latin-1") for w in words)
        ids = np.fromiter((i for _, i in self._automaton.iter_long(text)), np.int64)
        breaks = ids < 0
        return np.cumsum(breaks)[~breaks], ids[~breaks]

    @cached_property
    def _bytes(self) -> tuple[list[int], list[int]]:
        """The id of every byte, and the rank of every two bytes."""
        ids = [self.ids.get(bytes([x]), -1) for x in range(256)]
        return ids, [self.rank_by_key.get(a * self.size + b, NEVER) for a in ids for b in ids]

    def merge(self, word: bytes) -> list[int]:
        """The exact encoding: the merge of lowest rank first, the leftmost of equal ones."""
        if len(word) > LONG_WORD:
            return self._merge_long(word)
        size, rank_by_key, made, by_byte, of_bytes = self.size, self.rank_by_key, self.made, *self._bytes
        parts = [by_byte[x] for x in word]
        ranks = [of_bytes[x << 8 | y] for x, y in zip(word, word[1:])]
        while ranks and (r := min(ranks)) != NEVER:
            i = ranks.index(r)
            parts[i : i + 2] = [c] = [made[r]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank_by_key.get(parts[i - 1] * size + c, NEVER)
            if i < len(ranks):
                ranks[i] = rank_by_key.get(c * size + parts[i + 1], NEVER)
        return parts

    def _merge_long(self, word: bytes) -> list[int]:
        """The same for words of any length: neighbours wait in a heap by (rank, place), and those
        of which a part is gone are passed over."""
        parts = [self.ids[word[i : i + 1]] for i in range(len(word))]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts) and (r := self.rank_by_key.get(parts[i] * self.size + parts[j])) is not None:
                heapq.heappush(heap, (r, i, j, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            r, i, j, a, b = heapq.heappop(heap)
            if parts[i] != a or parts[j] != b or after[i] != j:
                continue
            parts[i], parts[j], after[i] = self.made[r], -1, after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p >= 0]

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Every word's ids as little-endian 32-bit bytes: proposed, checked all at once, and merged
        where the check fails. Words are not empty."""
        if not words:
            return []
        if not self.ordered:
            return [_packed(self.merge(w)) for w in words]
        owner, ids = self.propose(words)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, place = np.unique(ids[inside] * self.size + ids[inside + 1], return_inverse=True)
        fits = self.compatible(pairs // self.size, pairs % self.size)[place]
        ends = (4 * np.searchsorted(owner, np.arange(len(words)), "right")).tolist()
        held = ids.astype("<u4").tobytes()
        out = [held[s:e] for s, e in zip([0, *ends], ends)]
        for w in np.unique(owner[inside[~fits]]).tolist():
            out[w] = _packed(self.merge(words[w]))
        return out


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Codec:
    """Encodes and decodes whole texts as the tokenizers library does by its file."""

    def __init__(self, path: str, special: bool = True):
        """``special``: whether strings of special tokens in texts become their ids."""
        import public_tokenizers
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cutter = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and not (model.get("byte_fallback") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or spec["normalizer"])
        if not plain or cutter["type"] != "ByteLevel" or cutter["add_prefix_space"] or not cutter["use_regex"] or spec["decoder"]["type"] != "ByteLevel":
            raise ValueError(f"{path}: only byte-level BPE with the usual pattern and no normalizer is known")
        added = spec["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError(f"{path}: added tokens that look at their neighbours are not known")
        alphabet = byte_alphabet()
        to_bytes = lambda token: bytes(alphabet[c] for c in token)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        names = {t["content"]: t["id"] for t in added}
        tokens = {i: to_bytes(t) for t, i in model["vocab"].items() if t not in names}
        self.merges = Merges(tokens, [(to_bytes(a), to_bytes(b)) for a, b in merges])
        self.bytes_of = tokens | {i: t.encode() for t, i in names.items()}
        self.added = names if special else {}
        self.cut = regex.compile(public_tokenizers.PATTERN).findall
        # Longer strings first: the library takes the longest at a place.
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else lambda text: [text]
        # The pattern always breaks before a space that a non-space follows. Elsewhere it decides.
        self.loose = regex.compile(r" (?:\s|\Z)").search
        self.spaced: dict[str, bytes] = {}  # by what follows the space

    def words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of words of the pattern as little-endian 32-bit bytes."""
        distinct = list(set(words))
        return dict(zip(distinct, self.merges.encode([w.encode("utf-8", "replace") for w in distinct])))

    def pieces(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Ids of pieces that follow a space, with the space. Letters alone are one word of the pattern."""
        cuts = {p: [" " + p] if p.isalpha() else self.cut(" " + p) for p in pieces}
        found = self.words(w for cut in cuts.values() for w in cut)
        return {p: found[cut[0]] if len(cut) == 1 else b"".join([found[w] for w in cut]) for p, cut in cuts.items()}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian 32-bit bytes, one value per text."""
        if len(self.spaced) > KEPT:
            self.spaced.clear()
        plans, words, new = [], set(), set()
        for text in texts:
            plan = []
            for part in self.split(text):
                if part in self.added:
                    plan.append(("id", self.added[part]))
                elif self.loose(part):
                    plan.append(("words", cut := self.cut(part)))
                    words.update(cut)
                elif part:
                    first, *rest = part.split(" ")
                    plan += [("words", cut := self.cut(first)), ("spaced", rest)]
                    words.update(cut)
                    new.update(rest)
            plans.append(plan)
        self.spaced.update(self.pieces([p for p in new if p not in self.spaced]))
        home = {"words": self.words(words), "spaced": self.spaced}
        return [b"".join([_packed([v]) if kind == "id" else b"".join(map(home[kind].__getitem__, v)) for kind, v in plan]) for plan in plans]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids, special tokens shown; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def codec(path: str) -> Codec:
    held = worker_state("bpe_codecs", dict)
    if path not in held:
        held[path] = Codec(path)
    return held[path]


def _lists(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def _ids_by_row(lists: pa.ListArray) -> Iterator[np.ndarray]:
    values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return (values[s:e] for s, e in zip(ends[:-1], ends[1:]))


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids array<int>) of every text of ``docs`` (doc_id, text), without special tokens added.

    A special token that a text spells becomes its one id, as by the library's default. A null or
    empty text has no ids. Repeated rows, null ids and empty tables come out as they are; other
    columns are not read. A task holds one batch of texts and the words it keeps.
    """
    small_batches(docs.sparkSession)

    def encode_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = codec(tokenizer)
        for batch in batches:
            ids = held.encode([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids)], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(encode_task, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text) of every row's ids; null ids are none and give an empty text."""

    def decode_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = codec(tokenizer)
        for batch in batches:
            texts = [held.decode(ids.tolist()) for ids in _ids_by_row(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(decode_task, f"doc_id {kind}, text string")


def digests(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (little-endian 32-bit) and of the decoded text."""

    def digest_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = codec(tokenizer)
        for batch in batches:
            n, of_ids, of_text = [], [], []
            for ids in _ids_by_row(batch.column(1)):
                n.append(ids.size)
                of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                of_text.append(hashlib.sha256(held.decode(ids.tolist()).encode("utf-8", "replace")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(digest_task, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
