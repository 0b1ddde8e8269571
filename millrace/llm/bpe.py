"""Byte-level BPE encoding and decoding by a prefix-sharing trie.

The words of a batch (pre-tokens, as bytes) are sorted, which lays their trie out in depth-first order: a word's
path is the stack of its prefixes, and the part it shares with its predecessor is kept. Each node holds one state, the
last token of the encoding of its prefix. That suffices: the encoding of a prefix of length i ends with the one token t
that is a suffix of the prefix and may follow the last token of the prefix before it, so a node costs a few look-ups
however deep it lies, and shared prefixes are encoded once. Walking back over the states gives a word's ids. Nodes of a
depth don't depend on each other, so numpy works on them together; words beyond REMEMBERED_BYTES, which are few and may
be very deep, are walked one node at a time.

Null text counts as empty; an empty text has no ids. The strings of added tokens inside a text become their ids, as the
tokenizers library has it. Long texts are read as a stream of words, and remembered words are bounded by
``remembered``; neither changes a result.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import tidy

#: The byte-level pre-token rule of this family of vocabularies (fixed value).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Its classes of characters: letters, numbers, blanks, others. None overlap.
CLASSES = {"L": r"\p{L}", "N": r"\p{N}", "W": r"\p{White_Space}", "P": r"[^\p{White_Space}\p{L}\p{N}]"}
#: Words whose trie is walked level by level at once.
LEVEL_WORDS = 1 << 15
#: Longer words are encoded but not remembered.
REMEMBERED_BYTES = 48
#: Characters of text whose words are held at once.
SLICE_CHARS = 1 << 20


def byte_of_char() -> dict[str, int]:
    """Printable Latin-1 stands for itself, the other bytes for 256 onward, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    table = {chr(b): b for b in plain}
    table.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))})
    return table


def token_bytes(path: str) -> dict[int, bytes]:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    chars = byte_of_char()
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    found = {i: bytes(chars[c] for c in s) for s, i in spec["model"]["vocab"].items() if s not in added}
    return found | {i: s.encode() for s, i in added.items()}


def plane_rule() -> re.Pattern:
    """PRE_TOKEN for texts of 16-bit characters, with its classes written out for the faster engine of the standard library."""
    plane = "".join(map(chr, range(1 << 16)))
    own = {}
    for name, rule in CLASSES.items():
        runs = (m.span() for m in regex.finditer(f"(?:{rule})+", plane))
        own[name] = "".join(f"\\u{a:04x}-\\u{b - 1:04x}" for a, b in runs)
    # letters and numbers go first, which changes nothing: where they match, the alternatives they have overtaken don't
    return re.compile(" ?[{L}]+| ?[{N}]+|'(?:[stmd]|re|ve|ll)| ?[{P}]+|[{W}]+(?![^{W}])|[{W}]+".format(**own))


class Vocabulary:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        self.bytes_of = token_bytes(path)
        self.id_of = {b: i for i, b in self.bytes_of.items() if i not in self.added.values()}
        #: rank of a merge by its two parts, and the parts of each merged token
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made_at: dict[int, int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocab[left], vocab[right]
            whole = vocab[left + right]
            self.rank[pair] = rank
            if whole not in self.parts:
                self.parts[whole] = pair
                self.made_at[whole] = rank
        #: tokens that their own bytes encode to
        whole = dict.fromkeys((i for i in self.bytes_of if i not in self.parts), True)
        for token in sorted(self.parts, key=self.made_at.__getitem__):
            left, right = self.parts[token]
            whole[token] = whole[left] and whole[right] and self._seam_holds(left, right, self.made_at[token])
        self.id_of = {b: i for b, i in self.id_of.items() if whole[i]}
        self.sizes = {i: len(b) for b, i in self.id_of.items()}
        self.known_follows: dict[int, bool] = {}

    def follows(self, left: int, right: int) -> bool:
        """Whether BPE over the bytes of both ends with exactly these two tokens: no merge across the seam comes in time."""
        key = left << 20 | right
        known = self.known_follows.get(key)
        if known is None:
            if len(self.known_follows) > 400_000:
                self.known_follows.clear()
            known = self.known_follows[key] = self._seam_holds(left, right, len(self.rank))
        return known

    def _seam_holds(self, left: int, right: int, until: int) -> bool:
        """Whether no merge across the seam of two tokens comes before the merge of rank until."""
        # Going back in time, the later of the two tokens' last merges is undone; what then stands at the seam stood there until that merge.
        while True:
            across = self.rank.get((left, right))
            if across is not None and across < until:
                return False
            made_left, made_right = self.made_at.get(left, -1), self.made_at.get(right, -1)
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                until, left = made_left, self.parts[left][1]
            else:  # of equal merges the leftmost comes first: one across the seam would have come before one to its right
                until, right = made_right + 1, self.parts[right][0]


class Recall:
    """Answers to keys, as far as 2**bits places hold them: a key takes the place of another there. Keys are not negative."""

    def __init__(self, bits: int) -> None:
        self.shift = np.uint64(64 - bits)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)

    def __call__(self, keys: np.ndarray, compute: Callable[[list[int]], list]) -> np.ndarray:
        place = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
        found = self.values[place].astype(np.int64)
        missed = np.flatnonzero(self.keys[place] != keys)
        if len(missed):
            wanted, which = np.unique(keys[missed], return_inverse=True)
            computed = np.array(compute(wanted.tolist()), np.int64)
            found[missed] = computed[which]
            # keys and values are written alike, so that the last of two keys at a place leaves both of its own
            own = (wanted.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
            _, one = np.unique(own, return_index=True)
            self.keys[own[one]], self.values[own[one]] = wanted[one], computed[one]
        return found


class TrieEncoder:
    def __init__(self, path: str, remembered: int = 400_000) -> None:
        self.vocabulary = Vocabulary(path)
        self.words, self.plane_words = regex.compile(PRE_TOKEN), plane_rule()
        added = sorted(self.vocabulary.added, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        self.remembered = remembered
        #: ids of words met before, as 32-bit numbers
        self.known: dict[str, bytes] = {}
        self._beginnings = {b[:k] for b in self.vocabulary.id_of for k in range(len(b) + 1)}
        self._texts, self._states, self._tokens = [b""], {b"": 0}, [()]
        self._steps: dict[int, int] = {}
        #: the same for whole levels: the tokens of all states in a row, and where each state's begin
        self._tried, self._first, self._listed = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), 1
        self._size_of = np.zeros(max(self.vocabulary.bytes_of, default=0) + 1, np.int64)
        self._size_of[list(self.vocabulary.sizes)] = list(self.vocabulary.sizes.values())
        self._stepped, self._followed = Recall(17), Recall(20)

    def _step(self, key: int) -> int:
        """The state after one more byte: the longest end of what was read that begins a token. Computed when first needed."""
        text = self._texts[key >> 8] + bytes((key & 255,))
        while text not in self._beginnings:
            text = text[1:]
        state = self._states.get(text)
        if state is None:
            state = self._states[text] = len(self._texts)
            self._texts.append(text)
            ends = ((len(text) - k, self.vocabulary.id_of.get(text[k:])) for k in range(len(text)))
            self._tokens.append(tuple((n, i) for n, i in ends if i is not None))
        self._steps[key] = state
        return state

    def encode_sorted(self, words: list[bytes]) -> Iterator[tuple[int, ...]]:
        """The ids of words given in byte order: one walk through their trie, depth first."""
        sizes, holds, follows = self.vocabulary.sizes, self.vocabulary.known_follows, self.vocabulary.follows
        steps, tokens = self._steps, self._tokens
        last, states = [-1], [0]  # of each prefix on the path: the last token (-1 at the root), and the tokens it can end with
        before = b""
        for word in words:
            shared, most = 0, min(len(word), len(before))
            if word[:most] == before[:most]:
                shared = most
            else:
                while word[shared] == before[shared]:
                    shared += 1
            del last[shared + 1 :], states[shared + 1 :]
            state = states[-1]
            for end in range(shared + 1, len(word) + 1):
                key = state << 8 | word[end - 1]
                state = steps.get(key)
                if state is None:
                    state = self._step(key)
                for size, token in tokens[state]:  # longest first; exactly one may stand here
                    if size == end:
                        break
                    left = last[end - size]
                    fits = holds.get(left << 20 | token)
                    if fits is None:
                        fits = follows(left, token)
                    if fits:
                        break
                else:
                    raise ValueError(f"the vocabulary can't encode {word[:end]!r}")
                last.append(token)
                states.append(state)
            before, at, ids = word, len(word), []
            while at:
                token = last[at]
                ids.append(token)
                at -= sizes[token]
            ids.reverse()
            yield tuple(ids)

    def encode_levels(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Likewise the ids in a row and where each word's end: the nodes of a depth are worked on together, each once."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        width = int(lengths.max(initial=1))
        letters = np.array(words, f"S{width}").view(np.uint8).reshape(len(words), width)
        shared = np.zeros(len(words), np.int64)  # bytes in common with the word before
        other = letters[1:] != letters[:-1]
        shared[1:] = np.minimum(np.where(other.any(1), other.argmax(1), width), np.minimum(lengths[1:], lengths[:-1]))
        last = np.full((width + 1, len(words)), -1, np.int32)
        states = np.zeros(len(words), np.int64)
        alive = np.arange(len(words))
        for end in range(1, width + 1):
            alive = alive[lengths[alive] >= end]
            new = shared[alive] < end
            nodes = alive[new]
            state = self._transitions(states[nodes] << 8 | letters[nodes, end - 1])
            token, left, turn = np.empty(len(nodes), np.int32), np.arange(len(nodes)), 0
            at, ends = self._first[state], self._first[state + 1]
            while len(left):  # longest first; exactly one may stand here
                place = at[left] + turn
                if (place >= ends[left]).any():
                    raise ValueError(f"the vocabulary can't encode {words[nodes[left[0]]][:end]!r}")
                tried = self._tried[place]
                size = self._size_of[tried]
                fits = size == end
                rest = np.flatnonzero(~fits)
                fits[rest] = self._follow(last[end - size[rest], nodes[left[rest]]], tried[rest])
                token[left[fits]] = tried[fits]
                left, turn = left[~fits], turn + 1
            group = np.cumsum(new) - 1
            last[end, alive] = token[group]
            states[alive] = state[group]
        # back over the states
        rounds, at, rows = [], lengths.copy(), np.flatnonzero(lengths)
        counts = np.zeros(len(words), np.int64)
        while len(rows):
            token = last[at[rows], rows]
            rounds.append((rows, token))
            counts[rows] += 1
            at[rows] -= self._size_of[token]
            rows = rows[at[rows] > 0]
        ends = np.cumsum(counts)
        flat = np.empty(int(counts.sum()), np.int32)
        for k, (rows, token) in enumerate(rounds):
            flat[ends[rows] - 1 - k] = token
        return flat, ends

    def _transitions(self, keys: np.ndarray) -> np.ndarray:
        """The state that follows for each key, a state and a byte."""

        def computed(wanted: list[int]) -> list[int]:
            found = []
            for key in wanted:
                state = self._steps.get(key)
                found.append(self._step(key) if state is None else state)
            return found

        found = self._stepped(keys, computed)
        for state in range(self._listed, len(self._tokens)):
            tokens = [i for _, i in self._tokens[state]]
            begin = int(self._first[state])
            if begin + len(tokens) > len(self._tried):
                self._tried = np.concatenate([self._tried, np.zeros(len(self._tried) + len(tokens), np.int32)])
            if state + 2 > len(self._first):
                self._first = np.concatenate([self._first, np.zeros(len(self._first), np.int64)])
            self._tried[begin : begin + len(tokens)] = tokens
            self._first[state + 1] = begin + len(tokens)
        self._listed = len(self._tokens)
        return found

    def _follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        holds, until = self.vocabulary._seam_holds, len(self.vocabulary.rank)
        return self._followed(left.astype(np.int64) << 20 | right, lambda keys: [holds(k >> 20, k & 0xFFFFF, until) for k in keys]).astype(bool)

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > self.remembered:
            self.known = {}
        known, in_order = self.known, sorted(words)  # by code points, which is the order of their bytes
        by_bytes = [w.encode("utf-8", "surrogatepass") for w in in_order]
        if any(len(b) > REMEMBERED_BYTES for b in by_bytes):
            long = [k for k, b in enumerate(by_bytes) if len(b) > REMEMBERED_BYTES]
            for k, ids in zip(long, self.encode_sorted([by_bytes[k] for k in long]), strict=True):
                known[in_order[k]] = array("i", ids).tobytes()
            in_order, by_bytes = [w for w, b in zip(in_order, by_bytes) if len(b) <= REMEMBERED_BYTES], [b for b in by_bytes if len(b) <= REMEMBERED_BYTES]
        for k in range(0, len(in_order), LEVEL_WORDS):
            flat, ends = self.encode_levels(by_bytes[k : k + LEVEL_WORDS])
            raw, begin = flat.tobytes(), 0
            for word, end in zip(in_order[k : k + LEVEL_WORDS], (4 * ends).tolist()):
                known[word] = raw[begin:end]
                begin = end

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[np.ndarray] = []
        held: list[list] = []
        chars = 0
        for text in texts:
            text = text or ""
            if len(text) > SLICE_CHARS:
                out += self._encode_held(held)
                held, chars = [], 0
                out.append(self._encode_long(text))
                continue
            held.append(self._split(text))
            chars += len(text)
            if chars > SLICE_CHARS:
                out += self._encode_held(held)
                held, chars = [], 0
        return out + self._encode_held(held)

    def _split(self, text: str) -> list:
        """Words, with the ids of added tokens between them."""
        plain = len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
        words = self.plane_words if plain else self.words
        if self.added is None or not self.added.search(text):
            return words.findall(text)
        found: list = []
        for piece in self.added.split(text):
            token = self.vocabulary.added.get(piece)
            found += words.findall(piece) if token is None else [token]
        return found

    def _encode_held(self, held: list[list]) -> list[np.ndarray]:
        new = {w for w in set(chain.from_iterable(held)).difference(self.known) if isinstance(w, str)}
        if len(self.known) + len(new) > self.remembered:  # start over, with the words of these texts
            words = {w for w in set(chain.from_iterable(held)) if isinstance(w, str)}
            self.known = {w: self.known[w] for w in words - new}
            if len(words) > self.remembered:
                new = words
        self.learn(new)
        known = self.known
        out = []
        for words in held:
            try:
                out.append(np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32))
            except KeyError:  # an added token's id stands among the words
                out.append(np.frombuffer(b"".join(known[w] if isinstance(w, str) else array("i", (w,)).tobytes() for w in words), np.int32))
        if any(len(w) > REMEMBERED_BYTES for w in new):
            for w in [w for w in new if len(w) > REMEMBERED_BYTES]:
                del known[w]
        return out

    def _encode_long(self, text: str) -> np.ndarray:
        ids: list[np.ndarray] = [np.empty(0, np.int32)]
        for piece in self.added.split(text) if self.added is not None else [text]:
            token = self.vocabulary.added.get(piece)
            if token is not None:
                ids.append(np.array([token], np.int32))
                continue
            block: list[str] = []
            for m in self.words.finditer(piece):
                block.append(m[0])
                if len(block) == 100_000:
                    ids += self._encode_held([block])
                    block = []
            ids += self._encode_held([block])
        return np.concatenate(ids)


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

_encoders: dict[tuple[str, int], TrieEncoder] = {}


def encoder(path: str, remembered: int = 400_000) -> TrieEncoder:
    """One encoder for each process."""
    key = path, remembered
    if key not in _encoders:
        _encoders[key] = TrieEncoder(path, remembered)
    return _encoders[key]


def with_field(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    """schema with the field last; an own column of that name gives way."""
    return T.StructType([f for f in schema.fields if f.name != name] + [T.StructField(name, kind)])


def encoding(path: str, text: str, ids: str, remembered: int) -> Batches:
    """Batches with the token ids of their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, remembered)
        for batch in batches:
            for part in small(batch, text):
                found = own.encode_batch(part.column(text).to_pylist())
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                flat = np.concatenate([np.empty(0, np.int32), *found])
                yield put(part, ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))

    return run


def decoding(path: str, ids: str, text: str) -> Batches:
    """Batches with the text of their token ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = token_bytes(path)
        table = [bytes_of.get(i, b"") for i in range(max(bytes_of) + 1)]
        for batch in batches:
            column = batch.column(ids)
            column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
            ends, flat = column.offsets.to_pylist(), column.values.to_numpy(zero_copy_only=False)
            there = column.is_valid().to_pylist()
            if len(flat) and (flat.min() < 0 or flat.max() >= len(table)):
                flat = np.where((flat < 0) | (flat >= len(table)), len(table), flat)
                own = [*table, b""]
            else:
                own = table
            found = [b"".join(map(own.__getitem__, flat[a:b].tolist())).decode("utf-8", "replace") if ok else None for a, b, ok in zip(ends, ends[1:], there)]
            yield put(batch, text, pa.array(found, pa.string()))

    return run


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", remembered: int = 400_000) -> DataFrame:
    """df with the token ids of its text, in one pass without a shuffle."""
    schema = with_field(df.schema, ids, T.ArrayType(T.IntegerType(), False))
    return df.mapInArrow(tidy(encoding(path, text, ids, remembered)), schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """df with the text of its token ids: their bytes in a row, read as UTF-8 with U+FFFD for what isn't. Null ids give null, ids outside the vocabulary nothing."""
    return df.mapInArrow(tidy(decoding(path, ids, text)), with_field(df.schema, text, T.StringType()))


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", remembered: int = 400_000) -> DataFrame:
    """df with the token ids of its text and the text they decode to, both by one worker a task: a chain of the two would hold two, each with tables of its own."""
    there, back = encoding(path, text, ids, remembered), decoding(path, ids, decoded)
    schema = with_field(with_field(df.schema, ids, T.ArrayType(T.IntegerType(), False)), decoded, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from back(there(batches))

    return df.mapInArrow(tidy(run), schema)


def small(batch: pa.RecordBatch, text: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of bounded text (or single rows)."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for k, n in enumerate(sizes):
        if total and total + n > most:
            yield batch.slice(start, k - start)
            start, total = k, 0
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def put(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    """The batch with the column last, in place of one of that name."""
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [column], [*names, name])


def digests(df: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, and SHA-256 of the ids and of the decoded text."""
    back = round_trip(df.select("doc_id", "text"), path)
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
