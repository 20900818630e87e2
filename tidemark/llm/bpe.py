"""Byte-level BPE on an executor: ids of whole texts, and exact counts at every prefix.

``Encoder`` gives the token ids that the ``tokenizers`` library gives, keeping
the ids of words it has met.  ``PrefixCounter`` is a dynamic program over the
bytes of a pre-token: the encoding of a prefix ends in the one vocabulary token
whose left neighbour (the last token of the rest) pairs with it under the merge
rules, so the count at every prefix follows from shorter prefixes.

Both split a text only where no pre-token can cross: before a blank between two
characters that are not white space.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import numpy as np
import regex

#: The pre-token pattern of this vocabulary (a fixed value of the file format).
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CHUNK = re.compile(r"(?<=\S)(?= \S)")
#: White space that isn't a single blank between two other characters.
RUN = re.compile(r"\s | \s|^\s|\s$")
RUNS = re.compile(r"(\s*)(\S*)")
#: The same pattern without needless backtracking, for the merge engine.
FAST_PIECE = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: Characters, and runs of white space, for which the engine's pattern isn't relied on.
NOT_FAST = re.compile("[^\x00-\u024f]|\\s{1000}")
#: Words that a worker remembers; beyond it the memory starts afresh.
REMEMBERED = 500_000
#: Characters of new pre-tokens that one pass takes (a longer one has a pass of its own), and what keeps them apart.
TOGETHER, APART = 65_536, "\u0100"


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in the vocabulary file: printable Latin-1
    characters stand for themselves, the others for 256, 257, ... in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=4)
def library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Token ids as little-endian bytes (uint32, or another type that holds them), equal to the library's.

    ``tiktoken`` merges by token rank; with a vocabulary numbered in the order of its
    merges that is the same encoding, several times faster, so whole texts go through
    it.  Where the numbering, a special string or a character beyond Latin letters could
    make a difference, the library encodes: word by word, with the words of late remembered.
    """

    def __init__(self, path: str):
        self.tokenizer = library(path)
        #: Words of late, and those before them: words that recur stay, in bounded memory.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.special: list[str] = []
        self.fast, self.sizes = self._engine(path)

    def _engine(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain, model = byte_alphabet(), spec["model"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if any(a >= b for a, b in zip(made, made[1:])) or made and min(made) < 256 or spec["normalizer"] or model.get("ignore_merges"):
            return None, None
        ranks = {bytes(plain[c] for c in t): i for t, i in model["vocab"].items() if t not in self.special}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for b, i in ranks.items():
            sizes[i] = len(b)
        return tiktoken.Encoding("words", pat_str=FAST_PIECE, mergeable_ranks=ranks, special_tokens={}), sizes

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str], kind: str = "<u4") -> list[bytes]:
        whole = [bool(self.fast) and not NOT_FAST.search(t) and not any(s in t for s in self.special) for t in texts]
        slow = iter(self._by_words([t for t, w in zip(texts, whole) if not w]))
        out = []
        for t, w in zip(texts, whole):
            if w:
                out.append(np.array(self.fast.encode_ordinary(t), kind).tobytes())
            else:
                ids = next(slow)
                out.append(ids if kind == "<u4" else np.frombuffer(ids, "<u4").astype(kind).tobytes())
        return out

    def _by_words(self, texts: list[str]) -> list[bytes]:
        plans, fresh = [], set()
        for t in texts:
            first, *words = t.split(" ")
            found = list(map(self.known.get, words))
            if not t or RUN.search(t):
                first, words, found = None, None, None  # runs of white space
            elif None in found:
                fresh.update(w for w, f in zip(words, found) if f is None)
            plans.append((first, words, found))
        new = self._learn(sorted(fresh))
        out = []
        for t, (first, words, found) in zip(texts, plans):
            if first is None:
                out.append(self._chunks(t))
            else:
                if None in found:
                    found = [new[w] if f is None else f for w, f in zip(words, found)]
                out.append(self._library(first) + b"".join(found))
        return out

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        if len(self.known) > REMEMBERED // 8:
            self.known, self.older = {}, self.known
        new = {w: ids for w in words if (ids := self.older.get(w)) is not None}
        words = [w for w in words if w not in new] if new else words
        latin = [w for w in words if self.fast and (w.isascii() or max(w) < "\u0250") and "<|" not in w]
        new |= {w: self._library(" " + w) for w in set(words).difference(latin)}
        if latin:
            ids = np.array(self.fast.encode_ordinary(" " + " ".join(latin)), np.int64)
            ends = np.cumsum(np.array([len(w) + 1 if w.isascii() else len(w.encode("utf-8")) + 1 for w in latin]))
            cuts = [0, *(4 * (np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1)).tolist()]
            raw = ids.astype("<u4").tobytes()
            new |= {w: raw[a:z] for w, a, z in zip(latin, cuts, cuts[1:])}
        self.known |= {w: ids for w, ids in new.items() if len(w) <= 64}
        return new

    def _chunks(self, text: str) -> bytes:
        """Texts with runs of white space: the same cuts, found by pattern."""
        out = []
        for c in CHUNK.split(text) if text else []:
            known = self.known.get(c[1:]) if c[0] == " " and len(c) > 1 else None
            out.append(known or self._library(c))
        return b"".join(out)


class PrefixCounter:
    """Exact token counts at every prefix of a text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        plain = byte_alphabet()
        as_bytes = lambda s: bytes(plain[c] for c in s)
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        vocab = {as_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.rank = {(vocab[as_bytes(a)], vocab[as_bytes(b)]): r for r, (a, b) in enumerate(pairs)}
        self.token = {i: b for b, i in vocab.items()}
        self.vocab = vocab
        #: The merge that makes a token, and its two halves; -1 for single bytes.
        self.made = dict.fromkeys(self.token, -1)
        self.halves: dict[int, tuple[int, int]] = {}
        for (a, b), r in self.rank.items():
            if (t := vocab[self.token[a] + self.token[b]]) not in self.halves:
                self.made[t], self.halves[t] = r, (a, b)
        #: Finds the tokens (length and id) that end at each byte, the longest first; bytes are Latin-1 characters.
        self.ending = ahocorasick.Automaton()
        for b, i in vocab.items():
            self.ending.add_word(b.decode("latin-1"), (len(b), i))
        self.ending.make_automaton()
        self.every_byte = all(bytes([x]) in vocab for x in range(256))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.pieces: dict[str, Sequence[int]] = {}
        self.chunks: dict[str, int] = {}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def _follows(self, a: int, b: int) -> bool:
        """Whether ``b`` may stand right after ``a`` in an encoding; after nothing, where ``a`` is negative.

        Undo the merges of both tokens from the last to the first; the pair is
        wrong if the tokens that met at the boundary would have merged earlier.
        """
        key = a, b
        if (ok := self.pairs.get(key)) is None:
            rank, made, halves = self.rank, self.made, self.halves
            limit = 1 << 60
            if a < 0:
                ok = self._stands(b)
            while ok is None:
                if (r := rank.get((a, b))) is not None and r < limit:
                    ok = False
                elif made[a] > made[b]:
                    limit, a = made[a], halves[a][1]
                elif made[b] < 0:
                    ok = True
                else:
                    limit, b = made[b] + 1, halves[b][0]
            if len(self.pairs) > REMEMBERED:
                self.pairs.clear()
            self.pairs[key] = ok
        return ok

    def _stands(self, a: int) -> bool:
        """Whether the encoding of a token's own bytes is that token."""
        if (ok := self.whole.get(a)) is None:
            half = self.halves.get(a)
            ok = self.whole[a] = half is None or self._stands(half[0]) and self._stands(half[1]) and self._first_merge(a, *half)
        return ok

    def _first_merge(self, a: int, left: int, right: int) -> bool:
        """Whether nothing at the boundary of a token's halves merges before they do."""
        rank, made, halves, limit = self.rank, self.made, self.halves, self.made[a]
        while True:
            if made[left] < 0 and made[right] < 0:
                return True
            if made[left] > made[right]:
                limit, left = made[left], halves[left][1]
            else:
                limit, right = made[right] + 1, halves[right][0]
            if (r := rank.get((left, right))) is not None and r < limit:
                return False

    def byte_counts(self, pieces: list[bytes]) -> list[list[int]]:
        """For each piece (one pre-token) the tokens of ``piece[:j]`` for j from 0 to its length.

        Time is the length times the longest vocabulary token at most.  All pieces go through
        one pass, kept apart by a character that no token holds.
        """
        joined = APART.join(p.decode("latin-1") for p in pieces)
        counts, last = [0] * (len(joined) + 1), [-1] * (len(joined) + 1)
        pairs = self.pairs
        for at, (size, t) in self.ending.iter(joined):
            if last[at + 1] < 0:
                k = at + 1 - size
                a = last[k]
                if (ok := pairs.get((a, t))) is None:
                    ok = self._follows(a, t)
                if ok:
                    counts[at + 1], last[at + 1] = counts[k] + 1, t
        out, start = [], 0
        for p in pieces:
            end = start + len(p)
            if not self.every_byte and -1 in last[start + 1 : end + 1]:
                raise ValueError("the vocabulary lacks a byte")
            out.append(counts[start : end + 1])
            start = end + 1
        return out

    def _learn(self, pieces: list[str]) -> dict[str, Sequence[int]]:
        """Tables of distinct new pre-tokens, those of usual length remembered."""
        new: dict[str, Sequence[int]] = {}
        at = 0
        while at < len(pieces):
            end, size = at, 0
            while end < len(pieces) and (end == at or size + len(pieces[end]) <= TOGETHER):
                size += len(pieces[end])
                end += 1
            raws = [p.encode("utf-8") for p in pieces[at:end]]
            for piece, raw, counts in zip(pieces[at:end], raws, self.byte_counts(raws)):
                if len(raw) > len(piece):
                    counts = [counts[j] for j in accumulate((len(c.encode("utf-8")) for c in piece), initial=0)]
                if piece in ("'re", "'ve", "'ll"):
                    counts[2] = 2  # cut short it is an apostrophe and a letter
                new[piece] = bytes(counts) if len(raw) < 256 else counts  # small, and no work for the garbage collector
            at = end
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        self.pieces |= {p: counts for p, counts in new.items() if len(p) <= 64}
        return new

    def tables(self, pieces: list[str]) -> list[Sequence[int]]:
        """For each piece (one pre-token) the tokens of ``piece[:j]`` for j from 0 to its characters."""
        found = list(map(self.pieces.get, pieces))
        if None in found:
            new = self._learn(list(dict.fromkeys(p for p, f in zip(pieces, found) if f is None)))
            found = [new[p] if f is None else f for p, f in zip(pieces, found)]
        return found

    def piece_counts(self, piece: str) -> Sequence[int]:
        return self.tables([piece])[0]

    def plain_count(self, text: str) -> int:
        """Tokens of a text without special strings."""
        return sum(counts[-1] for counts in self.tables(PIECE.findall(text)))

    def count(self, text: str) -> int:
        """Tokens of the text: the last entry of its prefix table, from the tables of its words."""
        if not text:
            return 0
        if self.cut and any(s in text for s in self.special):
            return sum(1 if part in self.special else self.count_plain_cached(part) for part in self.cut.split(text) if part)
        return self.count_plain_cached(text)

    def count_plain_cached(self, text: str) -> int:
        first, *words = text.split(" ")
        chunks = self.chunks
        found = list(map(chunks.get, words))
        if None in found or not first or first[-1].isspace():
            if RUN.search(text):
                return self.plain_count(text)
            if None in found:
                new = self._words(list(dict.fromkeys(w for w, f in zip(words, found) if f is None)))
                found = [new[w] if f is None else f for w, f in zip(words, found)]
        return self.plain_count(first) + sum(found)

    def _words(self, words: list[str]) -> dict[str, int]:
        """Tokens of distinct new words with a blank before them, which begins a pre-token."""
        pieces, totals = PIECE.findall(" " + " ".join(words)), []
        for p, counts in zip(pieces, self.tables(pieces)):
            if p[0] == " ":
                totals.append(counts[-1])
            else:
                totals[-1] += counts[-1]
        new = dict(zip(words, totals, strict=True))
        if len(self.chunks) > REMEMBERED:
            self.chunks.clear()
        self.chunks |= {w: n for w, n in new.items() if len(w) <= 64}
        return new

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of ``text[:j]`` for every j from 0 to the number of characters."""
        if not (self.cut and any(s in text for s in self.special)):
            return self._plain_prefix_counts(text)
        out, done, before = [np.zeros(1, np.int64)], 0, ""
        for part in self.cut.split(text):
            if part in self.special:
                # Until its last character is read, a special string is ordinary text.
                tail = CHUNK.split(before)[-1]
                cut_short = self._plain_prefix_counts(tail + part[:-1])
                out.append(done - cut_short[len(tail)] + cut_short[len(tail) + 1 :])
                done, before = done + 1, ""
                out.append(np.array([done]))
            elif part:
                counts = self._plain_prefix_counts(part)
                out.append(done + counts[1:])
                done, before = done + counts[-1], part
        return np.concatenate(out)

    def _plain_prefix_counts(self, text: str) -> np.ndarray:
        out, done, at = np.zeros(len(text) + 1, np.int64), 0, 0
        for m in RUNS.finditer(text):
            blanks, word = m[1], m[2]
            if blanks:
                # As long as the text ends here, the whole run is one pre-token ...
                out[at + 1 : at + 1 + len(blanks)] = [done + c for c in self.piece_counts(blanks)[1:]]
                at += len(blanks)
                if not word:
                    break
                # ... and once a word follows, its last character stands apart.
                if len(blanks) > 1:
                    done += self.piece_counts(blanks[:-1])[-1]
                if blanks[-1] == " ":
                    word = " " + word
                    at -= 1
                else:
                    done += self.piece_counts(blanks[-1])[-1]
            for k, p in enumerate(PIECE.findall(word)):
                got = self.piece_counts(p)
                skip = 1 if k == 0 and p[0] == " " else 0
                out[at + 1 + skip : at + 1 + len(p)] = [done + c for c in got[1 + skip :]]
                done += got[-1]
                at += len(p)
        return out
