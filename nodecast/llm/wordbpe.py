"""Word-level BPE by a pair occurrence index.

``WordBpe`` reads a tokenizer file of the public word-end kind (words are split
by a pattern, the last byte of a word carries an end mark, no byte fallback).
Texts become pre-tokens; the *distinct* pre-tokens of a batch are encoded
together: one index maps each pair of neighbouring symbols to all its positions
in the batch, the active ranks are applied in ascending order, and each merge
moves only the lists of the two pairs next to it.

Nothing here knows Spark; the callers run it inside tasks on bounded batches.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import regex

# fixed values: the pre-token pattern of the public file, and white space as its library sees it
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# outside of plain Latin text, whose letters are composed and have one lower-case form each
NOT_LATIN = re.compile(
    r"[^\t-\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u0137\u0139-\u0148\u014a-\u017f]"
)
NOT_SPACE = re.compile(f"[^{SPACE}]+")
# fixed values: capitals of Unicode 16 and 17, which the library lower-cases and Python 3.13 does not
LATER_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB, 0xA7DC: 0x019B, **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
# fixed values: letters and numbers that Unicode 16 added, first and last of each run
ADDED = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C), (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9),
    (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA),
)
LATER = re.compile("[" + "".join(map(chr, LATER_LOWER)) + "]")


def pre_token_pattern() -> regex.Pattern:
    """The pattern with letters and numbers as the library knows them: those of
    Unicode 15, as ``unicodedata`` has them, and 16.  ``regex`` knows later ones too."""
    added = {c for first, last in ADDED for c in range(first, last + 1)}
    unknown = (c for c in range(sys.maxunicode + 1) if c not in added and unicodedata.category(chr(c)) == "Cn")
    later = regex.findall(r"[\p{L}\p{N}]+", "".join(map(chr, unknown)))
    runs = [run for found in later for run in _runs([ord(c) for c in found])]
    if not runs:
        return regex.compile(PATTERN.replace(r"\s", SPACE))
    later = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)
    letters, numbers = (rf"(?:(?![{later}])\p{{{kind}}})" for kind in "LN")
    other = rf"(?:[^{SPACE}\p{{L}}\p{{N}}]|[{later}])"
    known = PATTERN.replace(r"[^\s\p{L}\p{N}]", other).replace(r"[\p{L}]", letters).replace(r"[\p{N}]", numbers)
    return regex.compile(known)


def _runs(numbers: list[int]) -> list[tuple[int, int]]:
    """First and last of each run of consecutive numbers."""
    cuts = [0, *(i for i in range(1, len(numbers)) if numbers[i] != numbers[i - 1] + 1), len(numbers)]
    return [(numbers[i], numbers[j - 1]) for i, j in zip(cuts, cuts[1:])]


class WordBpe:
    """Vocabulary, merges and special strings of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        pre = spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or pre[0]["pattern"]["Regex"] != PATTERN:
            raise ValueError(f"{path} is not a word BPE file of the supported kind")
        vocab: dict[str, int] = model["vocab"]
        self.vocab = vocab
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.pre_token = pre_token_pattern()
        self.special_split = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self.tokens = np.empty(max([*vocab.values(), *special.values()]) + 1, dtype=object)
        for text, number in (vocab | special).items():
            self.tokens[number] = text
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.left, self.right = left, right
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        # ascending ranks are only exact when no merge can wake a lower rank
        born = np.full(len(self.tokens), -1)
        born[self.made] = np.arange(len(pairs))
        if len(np.unique(self.made)) != len(pairs) or (
            np.maximum(born[left], born[right]) >= np.arange(len(pairs))
        ).any():
            raise ValueError(f"{path}: merges are not in order of their parts")
        key = left << 32 | right
        self.order = np.argsort(key)
        self.keys = key[self.order]
        letters = byte_letters()
        self.inside = np.array([vocab[c] for c in letters], dtype=np.int32)
        self.at_end = np.array([vocab[c + self.suffix] for c in letters], dtype=np.int32)

    # -- text to pieces to pre-tokens ---------------------------------------

    def pieces(self, text: str) -> list[str]:
        """What lies between white space, lower-cased; a special string stands
        for itself, after a space, which no other piece holds: what only looks
        like one once it is lower-cased is text."""
        if "<|" not in text:
            return lower_pieces(text)
        found: list[str] = []
        for part in self.special_split.split(text):
            found.extend([" " + part] if part in self.special else lower_pieces(part))
        return found

    def pre_tokens(self, piece: str) -> list[str]:
        if piece[0] == " " or piece.isalpha():
            return [piece]
        return self.pre_token.findall(piece)

    # -- pre-tokens to ids --------------------------------------------------

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair, -1 where there is none."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and the offset of each word (one more
        offset than words).  Special strings, after a space, give their own id."""
        if not words:
            return np.empty(0, np.int32), np.zeros(1, np.int64)
        raw = [b"\0" if w[0] == " " else w.encode("utf-8") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(sizes)
        starts = ends - sizes
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        n = len(data)
        ids = self.inside[data]
        ids[ends - 1] = self.at_end[data[ends - 1]]
        after = np.arange(1, n + 1, dtype=np.int32)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1, dtype=np.int32)
        before[starts] = -1
        for i in (i for i, w in enumerate(words) if w[0] == " "):
            ids[starts[i]] = self.special[words[i][1:]]
        self._merge(ids, before, after)
        alive = ids >= 0
        counts = np.concatenate(([0], np.cumsum(alive)))
        return ids[alive], np.concatenate(([0], counts[ends]))

    def _merge(self, ids: np.ndarray, before: np.ndarray, after: np.ndarray) -> None:
        first = np.flatnonzero(after >= 0)
        rank = self.ranks(ids[first], ids[first + 1])
        first, rank = first[rank >= 0], rank[rank >= 0]
        by_rank = np.argsort(rank, kind="stable")
        first, rank = first[by_rank], rank[by_rank]
        active, at = np.unique(rank, return_index=True)
        index: dict[int, list] = defaultdict(list)
        for r, places in zip(active.tolist(), np.split(first, at[1:]) if len(at) else []):
            index[r].append(places)
        heap = active.tolist()
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            left, right = self.left[r], self.right[r]
            places = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            second = after[places]
            fits = (second >= 0) & (ids[places] == left) & (ids[second] == right)
            places, second = places[fits], second[fits]
            if left == right and len(places) > 1:  # in a run, from the left
                keep, taken = [], -1
                for p, q in zip(places.tolist(), second.tolist()):
                    keep.append(p != taken)
                    taken = q if p != taken else taken
                places, second = places[keep], second[keep]
            if not len(places):
                continue
            made = self.made[r]
            ids[places] = made
            ids[second] = -1
            beyond = after[second]
            after[places] = beyond
            has = beyond >= 0
            before[beyond[has]] = places[has]
            prior = before[places]
            old = prior >= 0
            heads = np.concatenate((prior[old], places[has]))
            fresh = self.ranks(ids[heads], ids[after[heads]])
            known = fresh >= 0
            heads, fresh = heads[known], fresh[known]
            if not len(heads):
                continue
            if len(heads) > 1:
                by_rank = np.argsort(fresh, kind="stable")
                heads, fresh = heads[by_rank], fresh[by_rank]
            cut = np.flatnonzero(fresh[1:] != fresh[:-1]) + 1
            bounds = [0, *cut.tolist(), len(heads)]
            for i, j in zip(bounds, bounds[1:]):
                woken = int(fresh[i])
                if woken not in index:
                    heapq.heappush(heap, woken)
                    index[woken].append(np.unique(heads[i:j]))
                else:
                    index[woken].append(heads[i:j])

    # -- ids to text --------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """The token strings with one space between them: the file names no
        decoder, so that is what its library returns."""
        return " ".join(self.tokens[ids].tolist())


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable,
    else the next free code point from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def lower_pieces(text: str) -> list[str]:
    if NOT_LATIN.search(text) is None:
        return text.lower().split()
    # one letter at a time: Python alone has a final sigma
    text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
    text = text.lower()
    return NOT_SPACE.findall(text.translate(LATER_LOWER) if LATER.search(text) else text)


class Numbering(dict):
    """Numbers words in order of first sight."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def gather(
    flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, wanted: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``wanted`` of ``flat`` end to end, and their offsets."""
    sizes = sizes[wanted]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    places = np.repeat(starts[wanted] - ends[:-1], sizes) + np.arange(ends[-1])
    return flat[places], ends


class Batch:
    """Some texts as numbers of their distinct pieces, and those as numbers of
    distinct pre-tokens."""

    def __init__(self, bpe: WordBpe, texts: Iterable[str]):
        seen, words, flat, sizes = Numbering(), Numbering(), [], []
        self.texts = []
        for text in texts:
            pieces = bpe.pieces(text)
            self.texts.append(np.fromiter(map(seen.__getitem__, pieces), np.int32, len(pieces)))
        for piece in seen:
            parts = bpe.pre_tokens(piece)
            flat.extend(map(words.__getitem__, parts))
            sizes.append(len(parts))
        self.words = list(words)
        self.piece_words = np.array(flat, dtype=np.int32)
        self.piece_offsets = np.concatenate(([0], np.cumsum(np.array(sizes, dtype=np.int64))))
