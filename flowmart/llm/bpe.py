"""BPE encoding as a bounded-lookahead streaming transducer, and incremental decoding.

The transducer reads the symbols of one word from left to right. A sequence of tokens is
what the merge list makes of a word exactly when each token is, and each two neighbours
stay two tokens when merged alone. So every prefix of a word has one last token, and a
token that all prefixes share from which a longer token could still start is final: it
is emitted and forgotten. What is kept is the last final token and the symbols after it,
at most `MergeList.lookahead` of them whatever the length of the word. These two are the
state of a finite transducer, whose steps are computed when first taken and remembered
in a table of bounded size.

Words are cut as the tokenizer file says: special tokens first, then composed and
lower-cased text, cut at white space and between letters, digits and other signs.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import Regex
from tokenizers.normalizers import NFC, Lowercase
from tokenizers.pre_tokenizers import Split

from flowmart.llm.arrow import bound_batches, once, text_function
from flowmart.llm.pieces import Memory, PieceTable

#: Steps of the transducer remembered at a time.
REMEMBERED = 1 << 16
#: Words, and pieces between white space, remembered at a time, twice.
REMEMBERED_WORDS = 1 << 17
#: Tokens decoded together.
TOKENS_TOGETHER = 1 << 19


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from 256."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in kept else next(free)) for b in range(256)]


SYMBOLS = byte_symbols()
_TO_SYMBOLS = dict(enumerate(SYMBOLS))
_TO_BYTES = {ord(s): b for b, s in enumerate(SYMBOLS)}


class MergeList:
    """Tokens and merges. A symbol is one character, or one and the word end."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], word_end: str):
        self.vocab, self.word_end = vocab, word_end
        self.rank = {tuple(pair): i for i, pair in reversed(list(enumerate(merges)))}
        self.merges = [tuple(pair) for pair in merges]
        self.text = {i: t for t, i in vocab.items()}
        self.longest = max(map(len, map(self.symbols, vocab)))
        made = {left + right: r for (left, right), r in self.rank.items()}
        #: Whether every merge comes after those that make its parts, as in learned lists.
        self.ordered = all(max(made.get(x, -1), made.get(y, -1)) < r for (x, y), r in self.rank.items())
        self.edges: dict[str, tuple[list, list] | None] = {}

    @cached_property
    def open(self) -> set[str]:
        """What a token that is not complete yet may look like."""
        return {t[:k] for t in self.vocab for k in range(1, len(self.symbols(t)))}

    def symbols(self, token: str) -> list[str]:
        if token.endswith(self.word_end) and len(token) > len(self.word_end):
            bare = token[: -len(self.word_end)]
            return [*bare[:-1], bare[-1] + self.word_end]
        return list(token)

    def _next(self, parts: list[str]) -> tuple[int, int] | None:
        """Rank and place of the merge that comes next: the lowest rank, then the leftmost."""
        return min(
            ((r, k) for k, p in enumerate(zip(parts, parts[1:], strict=False)) if (r := self.rank.get(p)) is not None),
            default=None,
        )

    def merged(self, parts: list[str]) -> list[str]:
        """The merges applied one by one: what the transducer must agree with."""
        while found := self._next(parts):
            k = found[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def edge(self, token: str) -> tuple[list[tuple[str, float]], list[tuple[str, float]]] | None:
        """Parts on the token's left and right edge, each with the rank of the merge that takes it.

        None for a text that is no token or that its own merges don't lead to.
        """
        if token in self.edges:
            return self.edges[token]
        found = None
        parts = self.symbols(token)
        if token in self.vocab:
            lefts, rights = [(parts[0], math.inf)], [(parts[-1], math.inf)]
            while len(parts) > 1 and (best := self._next(parts)):
                rank, k = best
                if k == 0:
                    lefts[-1] = (parts[0], rank)
                    lefts.append((parts[0] + parts[1], math.inf))
                if k == len(parts) - 2:
                    rights[-1] = (parts[-1], rank)
                    rights.append((parts[-2] + parts[-1], math.inf))
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            found = (lefts, rights) if len(parts) == 1 else None
        self.edges[token] = found
        return found

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether two tokens next to each other are not merged, in whole or in part."""
        if not self.ordered:
            return self.merged([*self.symbols(left), *self.symbols(right)]) == [left, right]
        # A merge over the border happens if it comes before both of its parts are taken
        # inside their tokens; of equal merges the one further left comes first.
        rank = self.rank
        for y, taken_y in self.edge(right)[0]:
            for x, taken_x in self.edge(left)[1]:
                over = rank.get((x, y))
                if over is not None and over < taken_x and over <= taken_y:
                    return False
        return True

    @property
    def lookahead(self) -> int:
        """Symbols after a final token that can matter to it.

        A merge is undone from the right only by an earlier merge that takes its right
        part, or a part on the right edge of that; each such step reaches over one token.
        The longest chain of steps times the longest token is sufficient.
        """
        splits: dict[str, tuple[str, str]] = {}
        chains: dict[str, int] = {}
        longest = 0
        for left, right in self.merges:
            edge, best = right, chains.get(right, 0)
            while edge in splits:
                edge = splits[edge][1]
                best = max(best, chains.get(edge, 0))
            chains[left] = max(chains.get(left, 0), best + 1)
            longest = max(longest, best + 1)
            splits.setdefault(left + right, (left, right))
        return (longest + 1) * self.longest


class Transducer:
    """Steps of one merge list: state and symbol give the next state and the final tokens.

    A state holds the symbols that are kept, and for each of their prefixes that a token
    can follow: where its last token starts, the token, and its cuts as bits of a number.
    """

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple[str, tuple]] = []
        self.numbers: dict[tuple[str, str], int] = {}
        self.steps: dict[tuple[int, str], tuple[int, tuple[int, ...]]] = {}
        self._state("", ((-1, "", 0),))

    def _state(self, kept: str, tails: tuple) -> int:
        """Number of the state; the last final token and the kept symbols tell states apart."""
        key = (tails[0][1], kept)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append((kept, tails))
        return number

    def _emit(self, tails: tuple, end: int) -> tuple[int, ...]:
        out = []
        while end > 0:
            start, token, _ = tails[end]
            out.append(self.merges.vocab[token])
            end = start
        return tuple(out[::-1])

    def _step(self, state: int, symbol: str) -> tuple[int, tuple[int, ...]]:
        merges = self.merges
        kept, tails = self.states[state]
        text, end = kept + symbol, len(kept) + 1
        tail = None
        for start in range(max(0, end - merges.longest), end):
            left = tails[start]
            if left and (token := text[start:]) in merges.vocab and merges.edge(token):
                if not left[1] or merges.stay_apart(left[1], token):
                    tail = (start, token, left[2] | 1 << end)
                    break
        tails = (*tails, tail)
        if len(symbol) > 1:  # the word ends
            step = (0, self._emit(tails, end))
        else:
            shared = tail[2] if tail else -1
            for at in range(end):
                if tails[at] and text[at:] in merges.open:
                    shared &= tails[at][2]
            cut = max(shared.bit_length() - 1, 0)
            after = tuple(
                (t[0] - cut, t[1], t[2] >> cut & ~1) if t and (k == 0 or t[2] >> cut & 1 or not cut) else None
                for k, t in enumerate(tails[cut:])
            )
            step = (self._state(text[cut:], after), self._emit(tails, cut))
        self.steps[state, symbol] = step
        return step

    def word(self, symbols: str) -> Iterator[int]:
        """Tokens of one word as they become final."""
        state = 0
        for symbol in symbols[:-1]:
            if len(self.steps) > REMEMBERED:
                # The state alone goes on; a word of any length needs no more.
                kept, tails = self.states[state]
                self.reset()
                state = self._state(kept, tails)
            step = self.steps.get((state, symbol)) or self._step(state, symbol)
            state = step[0]
            yield from step[1]
        last = symbols[-1] + self.merges.word_end
        yield from (self.steps.get((state, last)) or self._step(state, last))[1]


class LockStep:
    """The transducer's steps for many words at once, a symbol of each per step.

    Words that end inside the merge list's lookahead need not emit before they end: the last
    token of each prefix, which is the transducer's state, is found for all words together,
    and the tokens are read off backwards from the ends. Words beyond the lookahead, or of
    more symbols than tables of this kind should have, are streamed one by one.
    """

    #: Symbols of a word at most. Words taken together.
    SYMBOLS = 64
    WORDS = 8192
    _BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, merges: MergeList):
        made = {left + right for left, right in merges.merges}
        if not merges.ordered or len(made) != len(merges.merges):
            raise ValueError("merges must come after those that make their parts, one for each token")
        self.symbols = min(self.SYMBOLS, merges.lookahead)
        self.size = max(merges.vocab.values()) + 1
        codes = {t: self._codes(merges, t) for t in merges.vocab}
        self.length = np.zeros(self.size, np.int64)
        for t, i in merges.vocab.items():
            self.length[i] = len(codes[t])
        self.longest = int(self.length.max())
        with np.errstate(over="ignore"):
            self.powers = self._power_table()
            marks = np.array([self._mark(c) for c in codes.values()], np.uint64)
        order = np.argsort(marks)
        self.marks, self.ids = marks[order], np.array(list(merges.vocab.values()))[order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(marks >> np.uint64(44)).astype(np.int64)] = True
        pairs = np.array([merges.vocab[x] * self.size + merges.vocab[y] for x, y in merges.merges], np.int64)
        by = np.argsort(pairs)
        self.pairs, self.ranks = pairs[by], by.astype(np.int64)
        self.paired = np.zeros(1 << 20, bool)
        self.paired[self._slot(pairs)] = True
        self._edges(merges)

    def _power_table(self) -> np.ndarray:
        table = np.ones(self.symbols + 1, np.uint64)
        table[1:] = np.cumprod(np.full(self.symbols, self._BASE))
        return table

    @staticmethod
    def _codes(merges: MergeList, token: str) -> list[int]:
        """Bytes of a token; the last one of a word is 256 higher."""
        end = token.endswith(merges.word_end) and len(token) > len(merges.word_end)
        codes = [_TO_BYTES[ord(c)] for c in (token[: -len(merges.word_end)] if end else token)]
        return [*codes[:-1], codes[-1] + 256 * end]

    def _mark(self, codes: list[int]) -> int:
        value = 0
        for c in codes:
            value = (value * int(self._BASE) + c + 1) & 0xFFFFFFFFFFFFFFFF
        return value

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * self._BASE) >> np.uint64(44)).astype(np.int64)

    def _edges(self, merges: MergeList) -> None:
        """Parts on each token's left and right edge and the rank that takes each, one list for all."""
        vocab, never = merges.vocab, np.iinfo(np.int64).max
        lefts = {t: [(i, never)] for t, i in vocab.items()}
        rights = {t: [(i, never)] for t, i in vocab.items()}
        for rank, (left, right) in enumerate(merges.merges):
            token = left + right
            lefts[token] = [*lefts[left][:-1], (vocab[left], rank), (vocab[token], never)]
            rights[token] = [*rights[right][:-1], (vocab[right], rank), (vocab[token], never)]
        for name, edges in (("left", lefts), ("right", rights)):
            counts = np.zeros(self.size, np.int64)
            for t, i in vocab.items():
                counts[i] = len(edges[t])
            flat = [part for t in sorted(vocab, key=vocab.get) for part in edges[t]]
            setattr(self, f"{name}_start", np.concatenate([[0], np.cumsum(counts)]))
            setattr(self, f"{name}_part", np.array([p for p, _ in flat], np.int64))
            setattr(self, f"{name}_taken", np.array([r for _, r in flat], np.int64))

    def _tokens(self, marks: np.ndarray) -> np.ndarray:
        """Token id of each mark, or -1."""
        out = np.full(marks.shape, -1, np.int64)
        at = np.flatnonzero(self.seen[(marks >> np.uint64(44)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.marks, marks[at]), len(self.marks) - 1)
        hit = self.marks[place] == marks[at]
        out[at[hit]] = self.ids[place[hit]]
        return out

    def _stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """As `MergeList.stay_apart`, for arrays of token ids."""
        n_right = self.right_start[left + 1] - self.right_start[left]
        n_left = self.left_start[right + 1] - self.left_start[right]
        counts = n_right * n_left
        source = np.repeat(np.arange(len(left)), counts)
        inner = np.arange(len(source)) - np.repeat(np.cumsum(counts) - counts, counts)
        x = self.right_start[left][source] + inner // n_left[source]
        y = self.left_start[right][source] + inner % n_left[source]
        pair = self.right_part[x] * self.size + self.left_part[y]
        at = np.flatnonzero(self.paired[self._slot(pair)])
        pair = pair[at]
        place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        known = self.pairs[place] == pair
        at, over = at[known], self.ranks[place[known]]
        merged = (over < self.right_taken[x[at]]) & (over <= self.left_taken[y[at]])
        out = np.ones(len(left), bool)
        out[source[at[merged]]] = False
        return out

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each word as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        by_length = sorted(range(len(words)), key=lambda k: len(words[k]))
        for start in range(0, len(words), self.WORDS):
            rows = by_length[start : start + self.WORDS]
            for row, ids in zip(rows, self._together([words[k] for k in rows]), strict=True):
                out[row] = ids
        return out

    def _together(self, words: list[bytes]) -> list[bytes]:
        lengths = np.array([len(w) for w in words])
        wide = int(lengths.max())
        codes = np.frombuffer(b"".join([w.ljust(wide, b"\0") for w in words]), np.uint8).reshape(-1, wide).astype(np.uint64)
        codes[np.arange(len(words)), lengths - 1] += np.uint64(256)
        total = np.zeros((len(words), wide + 1), np.uint64)
        for k in range(wide):
            total[:, k + 1] = total[:, k] * self._BASE + codes[:, k] + np.uint64(1)
        last = np.full((len(words), wide + 1), -1, np.int64)
        for end in range(1, wide + 1):
            rows = np.arange(np.searchsorted(lengths, end), len(words))  # sorted by length
            first = max(0, end - self.longest)
            marks = total[rows, end][:, None] - total[rows, first:end] * self.powers[end - first : 0 : -1]
            token = self._tokens(marks.ravel())
            found = np.flatnonzero(token >= 0)
            row, begin, token = rows[found // (end - first)], first + found % (end - first), token[found]
            left = last[row, begin]
            begins = begin == 0
            last[row[begins], end] = token[begins]
            inner = np.flatnonzero(~begins & (left >= 0))
            good = inner[self._stay_apart(left[inner], token[inner])]
            # A prefix has one last token, unless the whole prefix is one.
            last[row[good], end] = token[good]
        return self._read_off(last, lengths)

    def _read_off(self, last: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        at, rows = lengths.copy(), np.arange(len(lengths))
        columns = []
        counts = np.zeros(len(lengths), np.int64)
        while (active := at > 0).any():
            token = np.where(active, last[rows, at], 0)
            columns.append(token)
            counts += active
            at = at - np.where(active, self.length[token], 0)
        table = np.stack(columns[::-1], axis=1).astype("<u4")
        width = table.shape[1]
        return [table[k, width - n :].tobytes() for k, n in enumerate(counts.tolist())]


def code_points() -> Iterator[tuple[int, str]]:
    """All that may stand in a text: first code point and characters of one part after another."""
    for first in range(0, 0x110000, 0x8000):
        if first != 0xD800 - 0x5800:
            yield first, "".join(map(chr, range(first, first + 0x8000)))
        else:  # without surrogates
            yield first, "".join(map(chr, range(first, 0xD800)))
            yield 0xE000, "".join(map(chr, range(0xE000, 0x10000)))


def class_ranges(kind: str) -> str:
    """Code points of a class such as `\\p{L}`, as the tokenizers library knows it, as ranges of a pattern.

    Python's own tables belong to another version of Unicode.
    """
    found = []
    for first, text in code_points():
        runs = Split(Regex(f"[^{kind}]+"), "removed").pre_tokenize_str(text)
        found += [f"\\U{first + a:08x}-\\U{first + b - 1:08x}" for _, (a, b) in runs]
    return "".join(found)


def lower_table() -> dict[int, str]:
    """Lower case of all code points that have another one, as the tokenizers library knows it."""
    table = {}
    for _, text in code_points():
        every = text.replace("\n", "")
        lowered = Lowercase().normalize_str("\n".join(every)).split("\n")
        table |= {ord(c): low for c, low in zip(every, lowered, strict=True) if c != low}
    return table


class Encoder:
    """A tokenizer file's encoding, piece by piece between white space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec["model"]["type"] != "BPE":
            raise ValueError(f"{path}: only composed, lower-cased BPE with word ends is built here")
        cut = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        for kind in (r"\p{L}", r"\p{N}", r"\s"):
            cut = cut.replace(kind, class_ranges(kind))
        self.words = re.compile(cut)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = MergeList(model["vocab"], merges, model["end_of_word_suffix"])
        self.transducer = Transducer(self.merges)
        self.lock_step = LockStep(self.merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text = self.merges.text | {i: t for t, i in self.special.items()}
        self.splits = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self.lower = lower_table()
        self.compose = NFC().normalize_str
        self.word_ids = Memory(self._words, REMEMBERED_WORDS)
        self.table = PieceTable(self._learned, "<u4", REMEMBERED_WORDS)

    def _plain(self, text: str) -> list[bytes]:
        """Words of a text without special tokens."""
        if text.isascii():
            text = text.lower()
            if text.isalpha():
                return [text.encode()]
        else:
            # Composed; a sigma's lower case doesn't depend on its place here.
            text = self.compose(text).translate(self.lower)
        return [w.encode() for w in self.words.findall(text)]

    def _parts(self, piece: str) -> list[bytes | int]:
        """Words and special tokens of a text without white space."""
        if not self.splits.search(piece):
            return self._plain(piece)
        out: list[bytes | int] = []
        at = 0
        for found in self.splits.finditer(piece):
            out += [*self._plain(piece[at : found.start()]), self.special[found[0]]]
            at = found.end()
        return out + self._plain(piece[at:])

    def long_word(self, word: bytes) -> Iterator[int]:
        """Token ids of a word of any length, as they become final."""
        return self.transducer.word(word.decode("latin-1").translate(_TO_SYMBOLS))

    def _words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words, short ones together."""
        short = [w for w in words if len(w) <= self.lock_step.symbols]
        made = dict(zip(short, self.lock_step.encode(short), strict=True))
        for word in words:
            if word not in made:
                made[word] = np.fromiter(self.long_word(word), "<u4").tobytes()
        return made

    def _learned(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces; their words are looked up together."""
        parts = {p: self._parts(p) for p in pieces}
        words = list({w for found in parts.values() for w in found if not isinstance(w, int)})
        ids: dict[bytes | int, bytes] = dict(zip(words, self.word_ids(words), strict=True))
        ids |= {i: i.to_bytes(4, "little") for i in self.special.values()}
        return {piece: b"".join([ids[w] for w in found]) for piece, found in parts.items()}

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """All token ids of each text as little-endian unsigned 32-bit integers."""
        column = pa.array(texts, pa.string())
        return [ids[a:b].tobytes() for ids, at in self.table.encode(column) for a, b in zip(at[:-1], at[1:], strict=True)]

    def encode_column(self, texts: pa.Array) -> pa.Array:
        """As `encode_batch`, for arrays."""
        parts = []
        for ids, at in self.table.encode(texts):
            offsets = (at * 4).astype(np.int32)
            data = np.ascontiguousarray(ids)
            parts.append(pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


class TokenText:
    """State machine from token ids to text, one id at a time.

    `spelled`: tokens as the vocabulary spells them, with a space between two, which is
    what a tokenizer without a decoder gives. Otherwise bytes are put together to
    characters, a character may span tokens, wrong bytes become U+FFFD, and a word end
    becomes a space.
    """

    def __init__(self, text: dict[int, str], word_end: str, spelled: bool):
        self.spelled, self.word_end = spelled, word_end
        self.text = text
        self.started = False
        self.need, self.held = 0, b""

    def feed(self, token: int) -> str:
        text = self.text[token]
        if self.spelled:
            out = " " + text if self.started else text
            self.started = True
            return out
        end = text.endswith(self.word_end)
        raw = bytes(_TO_BYTES[ord(c)] for c in (text[: -len(self.word_end)] if end else text))
        return "".join(map(self._byte, raw)) + (self.finish() + " " if end else "")

    def _byte(self, byte: int) -> str:
        if self.need and 0x80 <= byte < 0xC0:
            self.held += bytes([byte])
            if len(self.held) < self.need:
                return ""
            out, self.held, self.need = self.held.decode("utf-8", "replace"), b"", 0
            return out
        out = self.finish()
        if byte < 0x80:
            return out + chr(byte)
        self.need = 2 if 0xC2 <= byte < 0xE0 else 3 if 0xE0 <= byte < 0xF0 else 4 if 0xF0 <= byte < 0xF5 else 0
        if not self.need:
            return out + "�"
        self.held = bytes([byte])
        return out

    def finish(self) -> str:
        out = "�" if self.held else ""
        self.held, self.need = b"", 0
        return out

    def transitions(self) -> list[str | None]:
        """What each token puts out after another one, by id.

        The spelled machine has two states, before the first token and after any, so a table
        of its outputs in the second runs it; the first token's lacks the space.
        """
        self.started = True
        return [self.feed(k) if k in self.text else None for k in range(max(self.text) + 1)]


def encoder(path: str) -> Encoder:
    return once(("bpe", path), lambda: Encoder(path))


def _encoded(path: str):
    return encoder(path).encode_column


def token_texts(path: str) -> tuple[dict[int, str], str]:
    """Spelling of each token id, special ones included, and the word end's."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    texts = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return texts, spec["model"]["end_of_word_suffix"]


def _outputs(path: str) -> pa.Array:
    return pa.array(TokenText(*token_texts(path), True).transitions(), pa.string())


def _decoded(path: str, spelled: bool):
    def fed(columns: pa.Array) -> pa.Array:
        texts, word_end = once(("texts", path), lambda: token_texts(path))
        out = []
        for ids in columns.to_pylist():
            machine = TokenText(texts, word_end, False)
            out.append("".join(chain(map(machine.feed, np.frombuffer(ids or b"", "<u4").tolist()), [machine.finish()])))
        return pa.array(out, pa.string())

    def run(columns: pa.Array) -> pa.Array:
        outputs = once(("outputs", path), lambda: _outputs(path))
        columns = columns.fill_null(b"")
        offsets = np.frombuffer(columns.buffers()[1], np.int32)[columns.offset : columns.offset + len(columns) + 1] // 4
        ids = np.frombuffer(columns.buffers()[2] or b"", "<u4")
        parts = []
        at = 0
        while at < len(columns):
            # A bounded number of tokens at a time; a longer text comes alone.
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + TOKENS_TOGETHER, "right")) - 1)
            spoken = outputs.take(pa.array(ids[offsets[at] : offsets[end]]))
            rows = pa.LargeListArray.from_arrays(pa.array((offsets[at : end + 1] - offsets[at]).astype(np.int64)), spoken)
            # The first token comes in the first state, without the space.
            parts.append(pc.utf8_slice_codeunits(pc.binary_join(rows, ""), 1))
            at = end
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return run if spelled else fed


def encode(text: Column | str, path: str) -> Column:
    """Token ids of a text as little-endian unsigned 32-bit integers; a null is an empty text."""
    return text_function(lambda: _encoded(path), "binary")(text)


def decode(ids: Column | str, path: str, spelled: bool = True) -> Column:
    """Text of token ids as `encode` gives them; see `TokenText`."""
    return text_function(lambda: _decoded(path, spelled), "string")(ids)


def token_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Per row of `docs`: doc_id, n_tokens, ids (binary) and decoded text.

    Every row gives one row, whatever repeats or is null. A null or empty text has no
    tokens. Other columns play no part.
    """
    bound_batches(docs.sparkSession)

    def both():
        encoded, decoded = _encoded(path), _decoded(path, True)

        def run(texts: pa.Array) -> pa.Array:
            ids = encoded(texts)
            return pa.StructArray.from_arrays([ids, decoded(ids)], names=["ids", "decoded"])

        return run

    made = docs.select("doc_id", text_function(both, "struct<ids:binary,decoded:string>")("text").alias("made"))
    return made.select(
        "doc_id",
        (F.octet_length("made.ids") / 4).cast("bigint").alias("n_tokens"),
        "made.ids",
        "made.decoded",
    )
