"""Whole-text encoding with the tokenizers library, as fast as its vocabulary repeats.

Byte-pair encoding works pre-token by pre-token, so a text can be cut wherever a pre-token must end,
each different unit is encoded once by the library, and the ids of equal units are reused. Cuts depend
on the tokenizer's own settings (:func:`_rule`); a tokenizer with other settings gets whole texts.

Units are cut at spaces first, by Arrow, which also numbers the different ones of a batch; only these are
looked up, and a text's ids are gathered by the numbers of its units. A unit that is not known yet is cut
further, after a word before punctuation, and pieces that are one word go, many at a time, to a tokenizer of
the library that has the same BPE model and splits at white space only, without the settings' regular
expressions and offsets.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units that a worker remembers: those met in one batch only, and those met again. Beyond that each starts afresh.
LATELY, OFTEN = 150_000, 300_000
#: The same where nothing else needs the worker's memory; about 150 bytes a unit.
ROOMY = (450_000, 450_000)
#: New words that the model gets at a time.
WORDS = 20_000
#: Characters of text, about, that are encoded at a time.
BATCH_CHARS = 4_000_000
_ODD_SPACE = re.compile(r" (?=\s)|\x00")
_BEFORE_WORD = re.compile(r"(?= [^\W_])")
#: After a letter (or other non-digit of a word) before what is no word character; after a lone line end before a word.
_PIECES = re.compile(r"(?<=[^\W\d_])(?=\W)|(?<=\S\n)(?=\w)")

#: ASCII that is in no word, but for the space.
_POINTS = pa.array([chr(c) for c in range(1, 128) if not chr(c).isalnum() and chr(c) not in "_ "], pa.large_string())


def _rule(settings: dict) -> str:
    """How texts may be cut.

    ``space``: byte-level pre-tokens that take the one space before them along (no normalizer): cut
    before a space that a non-space follows. ``blank``: white space is dropped by the pre-tokenizer
    and nothing looks across it: cut at it. ``whole``: anything else.
    """
    pre, norm = settings.get("pre_tokenizer") or {}, settings.get("normalizer")
    if settings.get("post_processor") or settings["model"].get("type") != "BPE":
        return "whole"
    if any(re.search(r"^\w|\s|\w$", x["content"]) or x["lstrip"] or x["rstrip"] for x in settings.get("added_tokens", [])):
        return "whole"
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
        return "space"
    steps = pre.get("pretokenizers") or []
    if (
        steps
        and steps[0]["type"] == "Split"
        and steps[0].get("invert")
        and steps[0]["behavior"] == "Removed"
        and steps[0]["pattern"].get("Regex") == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        and all(x["type"] == "ByteLevel" and not x["use_regex"] and not x["add_prefix_space"] for x in steps[1:])
        and {x["type"] for x in (norm or {}).get("normalizers", [])} == {"NFC", "Replace", "Lowercase"}
    ):
        return "blank"
    return "whole"


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(moved)}


def _gathered(values: np.ndarray, size: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``values`` (``size`` of each, one after the other) by their numbers, and where each ends."""
    n = size[numbers]
    ends = np.cumsum(n)
    shift = (np.cumsum(size) - size)[numbers] - (ends - n)
    return values[np.repeat(shift, n) + np.arange(n.sum())], ends


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers, without special tokens.

    ``plain``: strings of special tokens inside texts are plain text. ``remembered``: units held, as LATELY and OFTEN.
    """

    def __init__(self, path: str, plain: bool = False, remembered: tuple[int, int] = (LATELY, OFTEN)):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        self.rule = _rule(settings)
        self.tokenizer.encode_special_tokens = plain
        added = [x["content"] for x in settings.get("added_tokens", []) if x["content"] and not (plain and x["special"])]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        # a string that goes on from a letter to a point at its end
        self.joined = any(re.search(r"[^\W\d_]\W$", x) for x in added)
        self.letters = _byte_letters()
        # the model alone: words in the byte-level alphabet, white space between them
        self.bare = Tokenizer(self.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        self.tiles = not settings["model"].get("unk_token")
        suffix = settings["model"].get("end_of_word_suffix") or ""
        vocabulary = self.bare.get_vocab()
        self.spelled = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for entry, i in vocabulary.items():
            self.spelled[i] = len(entry.removesuffix(suffix))
        self.most_lately, self.most_often = remembered
        self.lately: dict[str, bytes] = {}
        self.often: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _units(self, text: str) -> list[str] | None:
        """Units of a text. For ``space`` they stand without the space before them, or after U+0000 if there is none.

        None for a text with U+0000 itself, which is encoded whole.
        """
        if self.rule == "blank":
            return text.replace("\n", " ").split(" ")
        if _ODD_SPACE.search(text):
            if "\0" in text:
                return None
            first, *rest = _BEFORE_WORD.split(text)
            return ["\0" + first, *(x[1:] for x in rest)] if first else [x[1:] for x in rest]
        units = text.split(" ")
        units[0] = "\0" + units[0]
        return units

    def _plain(self, unit: str) -> str:
        """The text of a unit."""
        if self.rule == "blank":
            return unit
        return unit[1:] if unit[:1] == "\0" else " " + unit

    def _cut(self, unit: str) -> list[str]:
        """A unit as units that end where a pre-token must."""
        text = self._plain(unit)
        if self.added.search(text) or " " in text[1:]:
            return [unit]
        # what Python's tables do not know yet may be a letter to the library
        if not text.isascii() and "Cn" in map(unicodedata.category, text):
            return [unit]
        # U+0130 is the one letter whose lower case ends in a mark
        if self.rule == "blank" and not text.isascii() and ("\u0130" in text or not unicodedata.is_normalized("NFC", text)):
            return [unit]
        parts = _PIECES.split(text)
        if self.rule == "blank":
            return parts
        return [x[1:] if x[:1] == " " else "\0" + x for x in parts]

    def _spelled(self, unit: str) -> str | None:
        """A unit that is a single word for the pre-tokenizer, in the byte-level alphabet."""
        space = self.rule == "space"
        bare = space and unit[:1] == "\0"
        word = unit[1:] if bare else unit
        if not word.isalpha():
            return None
        if word.isascii():
            spelled = word if space else word.lower()
        else:
            if not space:
                word = "".join(map(str.lower, unicodedata.normalize("NFC", word)))
                if not word.isalpha():
                    return None
            spelled = word.encode().decode("latin-1").translate(self.letters)
        return "\u0120" + spelled if space and not bare else spelled  # the byte of a space

    def _words(self, spelled: list[str]) -> list[bytes]:
        """Ids of words in the byte-level alphabet, from the BPE model alone."""
        out: list[bytes] = []
        for at in range(0, len(spelled), WORDS):
            some = spelled[at : at + WORDS]
            ids = np.array(self.bare.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            # the tokens of a word tile it
            reach = np.cumsum(self.spelled[ids])
            ends = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))
            last = np.searchsorted(reach, ends)
            if self.tiles and len(reach) and reach[-1] == ends[-1] and (reach[last] == ends).all():
                raw, cuts = ids.tobytes(), (4 * (last + 1)).tolist()
                out.extend([raw[i:j] for i, j in zip([0, *cuts], cuts, strict=False)])
            else:
                out.extend(np.array([x.id for x in self.model.tokenize(w)], "<u4").tobytes() for w in some)
        return out

    def _learn(self, units: list[str]) -> dict[str, bytes]:
        """Ids of new units."""
        words, cut = {}, []
        for unit in units:
            spelled = self._spelled(unit)
            if spelled is None:
                cut.append(unit)
            else:
                words[unit] = spelled
        parts = [self._cut(x) for x in cut]
        hard = [x for x, p in zip(cut, parts, strict=True) if len(p) == 1]
        pieces: dict[str, bytes] = {}
        for unit in set(chain.from_iterable(parts)).difference(words, hard):
            ids = self.often.get(unit) or self.lately.get(unit)
            if ids is not None:
                pieces[unit] = ids
            elif (spelled := self._spelled(unit)) is None:
                hard.append(unit)
            else:
                words[unit] = spelled
        new = dict(zip(words, self._words(list(words.values())), strict=True))
        for at in range(0, len(hard), WORDS):
            some = hard[at : at + WORDS]
            new.update(zip(some, self._ids([self._plain(x) for x in some]), strict=True))
        pieces |= new
        new.update((unit, b"".join(map(pieces.__getitem__, x))) for unit, x in zip(cut, parts, strict=True))
        return new

    def _numbered(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, list[int], np.ndarray, list[int]]:
        """The different units of texts; their numbers, text after text; which texts, the units of each; texts that are encoded whole."""
        whole: list[int] = []
        if self.rule == "blank":
            easy, odd = list(range(len(texts))), []
            ready = [x.replace("\n", " ") for x in texts]
        else:
            easy, odd = [], []
            for i, x in enumerate(texts):
                (odd if _ODD_SPACE.search(x) else easy).append(i)
            ready = ["\0" + texts[i] for i in easy]
        lists = pc.split_pattern(pa.array(ready, pa.large_string()), " ")
        counts = [np.diff(lists.offsets.to_numpy())]
        values = [lists.flatten()]
        for i in odd:
            units = self._units(texts[i])
            if units is None:
                whole.append(i)
            else:
                easy.append(i)
                values.append(pa.array(units, pa.large_string()))
                counts.append(np.array([len(units)]))
        found = pa.concat_arrays(values).dictionary_encode()
        return found.dictionary, found.indices.to_numpy(), easy, np.concatenate(counts), whole

    def _ends_word(self, letter: str) -> bool:
        """Whether a pre-token ends between this character and what is no word character in ASCII."""
        # U+0130 is the one letter whose lower case ends in a mark
        return letter.isalpha() and (self.rule == "space" or (letter != "\u0130" and unicodedata.is_normalized("NFC", letter)))

    def _pointed(self, units: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Different pieces of units, the numbers of each unit's pieces, and whether it has two: a point after a letter is one of its own."""
        last = pc.utf8_slice_codeunits(units, -1)
        before = pc.utf8_slice_codeunits(units, -2, -1).dictionary_encode()
        letters = np.array([self._ends_word(x) for x in before.dictionary.to_pylist()], bool)
        two = letters[before.indices.to_numpy()] & pc.is_in(last, _POINTS).to_numpy(zero_copy_only=False)
        if self.joined:
            two[:] = False
        mask = pa.array(two)
        points = last.filter(mask)
        if self.rule == "space":
            points = pc.binary_join_element_wise(pa.scalar("\0", pa.large_string()), points, pa.scalar("", pa.large_string()))
        heads = pc.if_else(mask, pc.utf8_slice_codeunits(units, 0, -1), units)
        found = pa.concat_arrays([heads, points]).dictionary_encode()
        numbers = found.indices.to_numpy()
        at = np.arange(len(two)) + np.cumsum(two) - two
        pieces = np.empty(len(numbers), numbers.dtype)
        pieces[at], pieces[at[two] + 1] = numbers[: len(two)], numbers[len(two) :]
        return found.dictionary, pieces, two

    def _unit_ids(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different units, one after the other, and where each ends."""
        if len(self.often) > self.most_often:
            self.often.clear()
        names, pieces, two = self._pointed(units)
        names = names.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.often.get, names))
        missing = [i for i, ids in enumerate(found) if ids is None]
        back = {u: self.lately.pop(u) for u in [names[i] for i in missing] if u in self.lately}
        self.often.update(back)
        new = self._learn([names[i] for i in missing if names[i] not in back])
        for i in missing:
            ids = back.get(names[i])
            found[i] = new[names[i]] if ids is None else ids
        if len(self.lately) + len(new) > self.most_lately:
            self.lately = new
        else:
            self.lately.update(new)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        every, ends = _gathered(np.frombuffer(b"".join(found), "<u4"), size, pieces)
        return every, np.concatenate(([0], ends))[np.cumsum(1 + two)]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of texts that are a space and one of these different words each."""
        if self.rule != "space":
            return self.encode([" " + x for x in words])
        easy = [x for x in words if x and " " not in x and "\0" not in x and not x[0].isspace()]
        every, ends = self._unit_ids(pa.array(easy, pa.large_string()))
        raw, cuts = every.tobytes(), (4 * ends).tolist()
        out = [raw[i:j] for i, j in zip([0, *cuts], cuts, strict=False)]
        if len(easy) == len(words):
            return out
        found = dict(zip(easy, out, strict=True))
        odd = [x for x in words if x not in found]
        found.update(zip(odd, self.encode([" " + x for x in odd]), strict=True))
        return [found[x] for x in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.rule == "whole":
            return self._ids(texts)
        units, numbers, order, counts, whole = self._numbered(texts)
        every, ends = self._unit_ids(units)
        every, ends = _gathered(every, np.diff(ends, prepend=0), numbers)
        raw = every.tobytes()
        cuts = 4 * np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        out = [b""] * len(texts)
        for i, start, end in zip(order, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            out[i] = raw[start:end]
        for i in whole:
            out[i] = self._ids([texts[i]])[0]
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str, remembered: tuple[int, int] = (LATELY, OFTEN)) -> Encoder:
    """One encoder per worker and tokenizer file."""
    return Encoder(path, remembered=remembered)


def forget_encoders() -> None:
    """Give back what this worker's encoders remember, for tasks of other kinds that follow in the same process."""
    encoder.cache_clear()


def in_batches(texts: Iterable[str | None], chars: int = BATCH_CHARS):
    """Ranges of ``texts`` of about ``chars`` characters (null counts as empty): ``(from, texts)``."""
    at, held, size = 0, [], 0
    for i, x in enumerate(texts):
        held.append(x or "")
        size += len(held[-1])
        if size >= chars:
            yield at, held
            at, held, size = i + 1, [], 0
    if held:
        yield at, held
