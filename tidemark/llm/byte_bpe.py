"""Byte-level BPE by speculation: propose the longest tokens, check neighbours, merge only failures.

A text is cut into words by the tokenizer's pattern. For the words that a batch brings anew a trie
proposes tokens, the longest that fits first. BPE gives that proposal exactly when every two
neighbours are compatible, that is, when encoding their joined bytes gives the two tokens again.
``Pairs.compatible`` tests all pairs of all new words at once: it takes both tokens apart, last
merge first, and looks at each pair of pieces that lay at the border for a merge that would have
come before the next merge on either side. Words with a failing pair are merged exactly.

Words are kept with their ids up to ``CACHED`` words, so a worker's memory is bounded. Only tokens
that BPE gives for their own bytes are proposed. Tokens that only special strings make, such as
an end mark, are found first in a text, unless ``special`` is false: then they are plain text.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Sequence
from functools import cache
from itertools import chain

import ahocorasick
import numpy as np
import regex
from tokenizers.pre_tokenizers import ByteLevel

CACHED = 1 << 18
LONG = 64  # characters; longer words are not kept
NEVER = np.iinfo(np.int64).max
_BREAK = b"\xff"  # in no UTF-8 text; stands between words

# No word of the pattern holds letters beside other signs, so no word begins like this.
_KEY = "\0a\0"

# The pattern that byte-level tokenizers of this kind are defined by: a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Bytes that stand for themselves in the vocabulary file; the others follow from code point 256 on.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_of_sign() -> dict[str, int]:
    """The byte that each character of the vocabulary file stands for."""
    rest = [b for b in range(256) if b not in set(_PLAIN)]
    return {chr(b): b for b in _PLAIN} | {chr(256 + k): b for k, b in enumerate(rest)}


@cache
def _young() -> tuple[frozenset[str], re.Pattern]:
    """Letters and numbers younger than Python's tables, and a quick test for what may be one.

    Libraries differ on these, so texts with them are cut into words by the tokenizer's own.
    """
    letter = regex.compile(r"[\p{L}\p{N}]")
    signs = {c for c in map(chr, range(0x370, 0x110000)) if unicodedata.category(c) == "Cn" and letter.match(c)}
    low = "".join(c for c in sorted(signs) if c < "\U00010000")
    return frozenset(signs), re.compile(f"[{low}\U00010000-\U0010ffff]")


class Pairs:
    """The merges of a vocabulary as arrays: rank, left and right part of each token, ranks of pairs."""

    def __init__(self, size: int, merges: Sequence[tuple[int, int, int]]):
        self.size = size
        self.made = np.full(size, -1, dtype=np.int64)
        self.left = np.arange(size)
        self.right = np.arange(size)
        times = np.zeros(size, dtype=np.int64)
        for rank, (a, b, c) in enumerate(merges):
            times[c] += 1
            if times[c] == 1:
                self.made[c], self.left[c], self.right[c] = rank, a, b
        keys = np.array([a * size + b for a, b, _ in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks = keys[order], order
        self.gives = np.array([c for _, _, c in merges], dtype=np.int64)
        self.sound = self._sound(times)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, or ``NEVER``."""
        if len(self._keys) == 0:
            return np.full(len(left), NEVER)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], NEVER)

    def compatible(self, left: np.ndarray, right: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge across the border of each pair comes first (and before ``until``).

        At equal ranks the merge further left comes first: a merge across the border wins over
        one to its right and loses to one on its left.
        """
        fine = np.ones(len(left), dtype=bool)
        at = np.arange(len(left))
        left, right = left.astype(np.int64), right.astype(np.int64)
        end_left = np.full(len(left), NEVER) if until is None else until.astype(np.int64)
        end_right = end_left.copy()
        while len(at):
            across = self.rank(left, right)
            wrong = (across < end_left) & (across <= end_right) & (across != NEVER)
            fine[at[wrong]] = False
            made_left, made_right = self.made[left], self.made[right]
            goes_on = ~wrong & ((made_left >= 0) | (made_right >= 0))
            undo_left = made_left > made_right
            end_left = np.where(undo_left, made_left, end_left)
            end_right = np.where(undo_left, end_right, made_right)
            left, right = np.where(undo_left, self.right[left], left), np.where(undo_left, right, self.left[right])
            at, left, right = at[goes_on], left[goes_on], right[goes_on]
            end_left, end_right = end_left[goes_on], end_right[goes_on]
        return fine

    def _sound(self, times: np.ndarray) -> np.ndarray:
        """Tokens that BPE gives for their own bytes by their one merge."""
        made = np.flatnonzero(self.made >= 0)
        good = times <= 1
        good[made] &= self.compatible(self.left[made], self.right[made], self.made[made])
        for t in made[np.argsort(self.made[made])]:
            good[t] &= good[self.left[t]] & good[self.right[t]]
        return good


def joiner(tokens: Sequence[bytes]) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """A function that gives the bytes of many ids in a row, and the end of each token in them."""
    lengths = np.array([len(t) for t in tokens], dtype=np.int64)
    start = np.cumsum(lengths) - lengths
    blob = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def joined(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = lengths[ids]
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        return blob[np.repeat(start[ids] - (end - size), size) + np.arange(total)], end

    return joined


class ByteBpe:
    """A byte-level BPE vocabulary in the JSON form of the tokenizers library."""

    def __init__(self, content: bytes, special: bool = True):
        spec = json.loads(content)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        known = (
            spec.get("normalizer") is None and model["type"] == "BPE" and before.get("type") == "ByteLevel"
            and before.get("use_regex", True) and not before["add_prefix_space"] and not model.get("dropout")
            and not model.get("ignore_merges") and not model.get("continuing_subword_prefix")
            and not model.get("end_of_word_suffix"))
        if not known:
            raise ValueError("not a plain byte-level BPE vocabulary")
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens that take in what stands beside them are not known")
        sign = byte_of_sign()
        vocab = model["vocab"]
        size = max([*vocab.values(), *added.values()]) + 1
        self.tokens = [b""] * size
        for text, i in vocab.items():
            self.tokens[i] = bytes(sign[c] for c in text)
        for text, i in added.items():
            self.tokens[i] = text.encode()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        self.pairs = Pairs(size, merges)
        self._merge = {(a, b): (rank, c) for rank, (a, b, c) in reversed(list(enumerate(merges)))}
        self._byte = np.full(256, -1, dtype=np.int64)
        for i in vocab.values():
            if len(self.tokens[i]) == 1:
                self._byte[self.tokens[i][0]] = i
        if (self._byte < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        self._trie = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i in vocab.values():
            if self.pairs.sound[i] and _BREAK not in self.tokens[i]:
                self._trie.add_word(self.tokens[i].decode("latin-1"), i)
        self._trie.make_automaton()
        self._pattern = regex.compile(PATTERN)
        self._young, self._maybe_young = _young()
        self._library = ByteLevel(add_prefix_space=False)
        self._added = added if special else {}
        marks = sorted(self._added, key=len, reverse=True)
        self._marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self._marked = {_KEY + text: np.int32(i).tobytes() for text, i in self._added.items()}
        self._kept = dict(self._marked)
        self.merged_words = self.proposed_words = 0
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.joined = joiner(self.tokens)

    def words(self, text: str) -> list[str]:
        """The words that merges do not leave. Added tokens must be taken out before."""
        if not text.isascii() and self._maybe_young.search(text) and not self._young.isdisjoint(text):
            return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]
        return self._pattern.findall(text)

    def _parts(self, text: str) -> list[str]:
        """The words of a text, and keys of the added tokens between them."""
        if not self._marks or not self._marks.search(text):
            return self.words(text)
        out: list[str] = []
        for k, piece in enumerate(self._marks.split(text)):
            out += [_KEY + piece] if k % 2 else self.words(piece)
        return out

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text, as the bytes of 32-bit integers."""
        parts = [self._parts(t) for t in texts]
        words = set().union(*parts)
        new = words - self._kept.keys()
        if len(self._kept) + len(new) > CACHED:
            self._kept = dict(self._marked)
            new = words - self._kept.keys()
        self._kept.update(self._encode_words(list(new)))
        out = [b"".join(map(self._kept.__getitem__, p)) for p in parts]
        for word in new:
            if len(word) > LONG:
                del self._kept[word]
        return out

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        if not words:
            return {}
        raw = list(map(str.encode, words))
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        text = _BREAK.join(raw)
        proposed = chain.from_iterable(self._trie.iter_long(text.decode("latin-1")))
        last, flat = np.fromiter(proposed, np.int64).reshape(-1, 2).T
        word = np.cumsum(np.frombuffer(text, dtype=np.uint8) == _BREAK[0], dtype=np.int64)[last]
        counts = np.bincount(word, minlength=len(words))
        whole = np.bincount(word, self.lengths[flat], minlength=len(words)) == size
        inside = np.flatnonzero(word[1:] == word[:-1])
        pairs, back = np.unique(flat[inside] * self.pairs.size + flat[inside + 1], return_inverse=True)
        fine = self.pairs.compatible(pairs // self.pairs.size, pairs % self.pairs.size)[back]
        whole[word[inside[~fine]]] = False
        ids = flat.astype(np.int32).tobytes()
        end = np.cumsum(counts) * 4
        out = {w: ids[b - n : b] for w, b, n in zip(words, end.tolist(), (4 * counts).tolist())}
        failed = [(words[k], raw[k].decode("latin-1")) for k in np.flatnonzero(~whole)]
        short = [(w, r) for w, r in failed if len(r) <= LONG]
        out.update(zip([w for w, _ in short], self._merged([r for _, r in short])))
        out.update((w, self._merged_long(r)) for w, r in failed if len(r) > LONG)
        self.proposed_words += len(words)
        self.merged_words += int((~whole).sum())
        return out

    def _merged(self, words: list[str]) -> list[bytes]:
        """The ids of words by their merges; each round makes the next merge of every word at once."""
        out = [b""] * len(words)
        ids = self._byte[np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank = self._ranks(ids, word, np.arange(len(ids)))
        while len(ids):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.minimum.reduceat(rank, first)
            over = least == NEVER
            if over.any():
                end = np.append(first[1:], len(ids))
                done = ids.astype(np.int32)
                for k, a, b in zip(word[first[over]].tolist(), first[over].tolist(), end[over].tolist()):
                    out[k] = done[a:b].tobytes()
                stays = np.repeat(~over, end - first)
                ids, word, rank, least = ids[stays], word[stays], rank[stays], least[~over]
                first = np.flatnonzero(np.diff(word, prepend=-1))
            if len(ids) == 0:
                break
            wanted = np.repeat(least, np.diff(np.append(first, len(ids))))
            hits = np.flatnonzero(rank == wanted)
            hits = hits[np.diff(word[hits], prepend=-1) != 0]
            ids[hits] = self.pairs.gives[rank[hits]]
            stays = np.ones(len(ids), dtype=bool)
            stays[hits + 1] = False
            ids, word, rank = ids[stays], word[stays], rank[stays]
            # Only the pairs of a merged token with its neighbours are new.
            hits -= np.arange(len(hits))
            beside = np.concatenate([hits[hits > 0] - 1, hits])
            rank[beside] = self._ranks(ids, word, beside)
        return out

    def _ranks(self, ids: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The ranks of the merges of the tokens at some places with those after them in their words."""
        out = np.full(len(at), NEVER)
        inside = np.flatnonzero(at < len(ids) - 1)
        inside = inside[word[at[inside]] == word[at[inside] + 1]]
        out[inside] = self.pairs.rank(ids[at[inside]], ids[at[inside] + 1])
        return out

    def _merged_long(self, word: str) -> bytes:
        """The ids of one long word; a heap holds the merges that are possible now."""
        ids: list[int] = self._byte[np.frombuffer(word.encode("latin-1"), dtype=np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        known = self._merge.get
        heap = [(hit[0], k, hit[1], a, b) for k, (a, b) in enumerate(zip(ids, ids[1:])) if (hit := known((a, b)))]
        heapq.heapify(heap)
        while heap:
            _, k, new, a, b = heapq.heappop(heap)
            j = after[k]
            if ids[k] != a or j >= n or ids[j] != b:
                continue
            ids[k], ids[j] = new, -1
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y < n and (hit := known((ids[x], ids[y]))):
                    heapq.heappush(heap, (hit[0], x, hit[1], ids[x], ids[y]))
        return np.array([i for i in ids if i >= 0], dtype=np.int32).tobytes()
