"""Token ids of texts by the ``tokenizers`` library, with repeated words encoded once."""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

END = 0


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The path of a vocabulary file in the installed package of public ones."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """The ids that ``Tokenizer.encode(text, add_special_tokens=False)`` gives.

    A byte-level tokenizer splits text at white space before it merges: a word with the
    one space or line feed before it always gives the same ids. Such units are encoded
    once and remembered (at most ``limit`` of them, besides those of the latest texts; those
    not met for long go first). A text with any other white space, or with an added token in
    it, is encoded as one piece, and so is every text if the tokenizer is of another kind.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as file:
            told = json.load(file)
        split = told.get("pre_tokenizer") or {}
        self.by_units = (
            told.get("normalizer") is None
            and told.get("truncation") is None
            and told.get("padding") is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
        )
        self.added = [t["content"] for t in told.get("added_tokens", [])]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        # A token of a byte-level vocabulary has one letter for each byte.
        self.widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.widths[number] = len(token)
        self.units = _Units(limit)
        self.firsts: dict[str, bytes | None] = {}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """One array of ids for each text; a null text is empty."""
        texts = [text or "" for text in texts]
        if not (self.by_units and texts):
            return [self._whole(text) for text in texts]
        special = np.array([any(t in text for t in self.added) for text in texts])
        # Each distinct unit of all the texts is looked up once.
        plain = pa.array(["" if odd else text for text, odd in zip(texts, special)], pa.large_string())
        column = pc.replace_substring(plain, "\n", " \n")
        split = pc.split_pattern(column, " ")
        words = split.flatten().dictionary_encode()
        found = list(map(self.units.__getitem__, words.dictionary.to_pylist()))
        self._encode_units()
        units = pa.array(found, pa.large_binary()).take(words.indices)
        offsets, data = np.frombuffer(units.buffers()[1], np.int64), units.buffers()[2]
        data = np.frombuffer(data or b"", np.uint8)
        bounds = split.offsets.to_numpy()
        irregular = np.zeros(len(units) + 1, np.int64)
        np.cumsum(units.is_null().to_numpy(zero_copy_only=False), out=irregular[1:])
        # A text's first word has no space before it.
        starts, ends = bounds[:-1] + 1, bounds[1:]
        odd = special | (irregular[ends] > irregular[starts])
        cuts = zip(texts, offsets[starts].tolist(), offsets[ends].tolist(), odd.tolist())
        return [self._joined(text, data[x:y], whole) for text, x, y, whole in cuts]

    def _joined(self, text: str, rest: np.ndarray, whole: bool) -> np.ndarray:
        """A text's ids from those of the units after its first word, unless it is one piece as a ``whole``."""
        first = None if whole else self._first(text)
        return self._whole(text) if first is None else np.frombuffer(first + rest.tobytes(), self.kind)

    def _first(self, text: str) -> bytes | None:
        """The ids of the word that a text begins with; None if it is no unit."""
        first = text[: min(x for x in (text.find(" "), text.find("\n"), len(text)) if x >= 0)]
        if first not in self.firsts:
            if len(self.firsts) >= 100_000:
                self.firsts.clear()
            plain = first == "" or not (first[0].isspace() or first[-1].isspace())
            self.firsts[first] = self._whole(first).tobytes() if plain else None
        return self.firsts[first]

    def _whole(self, text: str) -> np.ndarray:
        # Without the offsets and tokens that only ``encode`` keeps.
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, self.kind)

    def _encode_units(self, at_once: int = 200) -> None:
        """Fill in the units met for the first time, many in one call."""
        waiting, self.units.waiting = self.units.waiting, []
        for start in range(0, len(waiting), at_once):
            some = waiting[start : start + at_once]
            texts = [u if u[0] == "\n" else f" {u}" for u, _ in some]
            ids = self._whole("".join(texts))
            reached = np.cumsum(self.widths[ids])
            ends = np.cumsum([len(t.encode()) for t in texts])
            cuts = np.searchsorted(reached, ends)
            if len(reached) and cuts[-1] < len(reached) and np.array_equal(reached[cuts], ends):
                begin = 0
                for (unit, place), cut in zip(some, (cuts + 1).tolist()):
                    self.units[unit] = found = ids[begin:cut].tobytes()
                    place += found
                    begin = cut
            else:
                for (unit, place), text in zip(some, texts):
                    self.units[unit] = found = self._whole(text).tobytes()
                    place += found
        self.units.age()


class _Units(dict):
    """Ids of units; a new one gets an empty place that is filled in later, or None if irregular.

    Once half of ``limit`` is held, all becomes ``older``; a unit met again comes back.
    """

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit
        self.older: dict[str, bytes | None] = {}
        self.waiting: list[tuple[str, bytearray]] = []

    def __missing__(self, unit: str) -> bytes | bytearray | None:
        found = self.older.get(unit)
        if found is not None:
            self[unit] = found
            return found
        word = unit[1:] if unit[:1] == "\n" else unit
        if not word or word[0].isspace() or word[-1].isspace():
            self[unit] = None
            return None
        place = self[unit] = bytearray()
        self.waiting.append((unit, place))
        return place

    def age(self) -> None:
        """Make room. No unit may be waiting."""
        if 2 * len(self) >= self.limit:
            self.older = dict(self)
            self.clear()


_KNOWN: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, loaded once in each worker."""
    if path not in _KNOWN:
        _KNOWN[path] = Encoder(path)
    return _KNOWN[path]
