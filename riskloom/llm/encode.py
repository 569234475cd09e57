"""Whole texts to token ids with the tokenizers library, each distinct unit encoded once.

Byte-level tokenizers with the usual split pattern never let a token cross a single
space between two non-blank characters, nor a single newline between them; tokenizers
that drop white space never let one cross any blank. Cutting there and encoding the
units apart gives the ids of the whole text, so a worker keeps the ids of units it has
met. Any other tokenizer gets whole texts. Tests compare both with the library.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re

import numpy as np

_TAIL = ".,;:!?#$%&*|"
_DOUBTFUL = {"", "\n", "\0"}
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=[^\s\0])")


class Encoder:
    """``encode(texts)``: little-endian uint32 ids of each text, as bytes.

    ``memo_units`` bounds the units a worker remembers; ``block_chars`` the characters
    whose units are held at once. Special-token strings in a text follow the library's
    own default.
    """

    def __init__(self, path: str, memo_units: int = 1_400_000, block_chars: int = 1 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        spec = json.loads(self.tok.to_str())
        self.mode = self._mode(spec)
        marks = [(t["content"], t["id"]) for t in spec.get("added_tokens", []) if t["special"]]
        self.mark = marks[-1] if marks and self.mode != "whole" else None
        self.memo_units, self.block_chars = memo_units, block_chars
        self.memo: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    @staticmethod
    def _mode(spec: dict) -> str:
        pre = spec.get("pre_tokenizer") or {}
        blank_free = all(not re.search(r"\s", t["content"]) and not t["lstrip"] and not t["rstrip"]
                         and not t["single_word"] for t in spec.get("added_tokens", []))
        if not blank_free:
            return "whole"
        if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] \
                and not spec.get("normalizer"):
            return "space"
        parts = pre.get("pretokenizers", [])
        if parts and parts[0].get("type") == "Split" and parts[0]["behavior"] == "Removed" \
                and parts[0]["invert"] and r"[^\s\p{L}\p{N}]+" in parts[0]["pattern"].get("Regex", "") \
                and " ?" not in parts[0]["pattern"]["Regex"]:
            return "blank"
        return "whole"

    def _units(self, text: str) -> list[str]:
        """Units whose ids in a row are the text's ids. In mode "space" a unit is kept
        without its leading space; one at a text's or line's start begins with a mark.
        Units that are blank or the mark alone tell ``_block`` to cut more carefully."""
        if self.mode == "whole":
            return [text] if text else []
        if self.mode == "blank":
            return text.replace("\n", " ").split(" ")
        if not text:
            return []
        if text.replace("\n", "").isprintable():  # no other white space
            return ("\0" + text).replace("\n", " \n").split(" ")
        return self._careful(text)

    @staticmethod
    def _careful(text: str) -> list[str]:
        parts = _SINGLE_SPACE.split(text)
        parts[0] = "\0" + parts[0]
        return parts

    def _plain(self, unit: str) -> str:
        if self.mode != "space":
            return unit
        return unit[1:] if unit[:1] == "\0" else unit if unit[:1] == "\n" else " " + unit

    def _pieces(self, text: str):
        """The text, or consecutive parts of a very long one, cut where units are cut."""
        if len(text) <= self.block_chars or self.mode == "whole":
            yield text, True
            return
        at, first = 0, True
        while at < len(text):
            cut = _SINGLE_SPACE.search(text, at + self.block_chars) if len(text) - at > self.block_chars else None
            end = cut.start() if cut else len(text)
            yield text[at:end], first
            at, first = (end + 1 if cut else end), False

    def _block(self, texts: list[tuple[str, bool]]) -> list[bytes]:
        get = self.memo.get
        found, missing = [], []
        for text, first in texts:
            for cut in (self._units, self._careful):
                units = cut(text)
                if not first and self.mode == "space" and units:
                    units[0] = units[0][1:]
                ids = list(map(get, units))
                gaps = []
                try:
                    at = ids.index(None)
                    while True:
                        gaps.append((ids, at, units[at]))
                        at = ids.index(None, at + 1)
                except ValueError:
                    pass
                if self.mode != "space" or cut == self._careful or not any(w in _DOUBTFUL for _, _, w in gaps):
                    break
            found.append(ids)
            missing += gaps
        fresh = {w for _, _, w in missing}
        memo = self.memo
        if len(memo) + len(fresh) > self.memo_units:
            for u in list(itertools.islice(memo, len(memo) // 2)):
                del memo[u]
        self._learn(fresh)
        for ids, at, w in missing:
            ids[at] = memo[w]
        if self.mode == "space":
            for w in _DOUBTFUL & fresh:  # must stay a miss, so that the quick cut notices
                del memo[w]
        return [b"".join(ids) for ids in found]

    def _learn(self, fresh: set[str]) -> None:
        """Ids of unknown units. Punctuation after a letter is a token group of its own,
        so a unit's stem and its tail are looked up apart; what is left goes to the
        library."""
        if self.mode == "whole":
            self._encode_units(list(fresh))
            return
        memo, stems, tailed = self.memo, set(), []
        for u in fresh:
            stem = u.rstrip(_TAIL)
            if len(stem) < len(u) and stem and stem[-1].isalpha():
                tailed.append((u, stem))
                if stem not in memo:
                    stems.add(stem)
            else:
                stems.add(u)
        self._encode_units(list(stems))
        for u, stem in tailed:
            tail = u[len(stem):]
            ids = self.tails.get(tail)
            if ids is None:
                ids = np.asarray(self.tok.encode(tail, add_special_tokens=False).ids, "<u4").tobytes()
                if len(self.tails) < 10_000:
                    self.tails[tail] = ids
            memo[u] = memo[stem] + ids

    def _encode_units(self, units: list[str]) -> None:
        """Many units go in one call, set apart by a special token, which the library cuts
        out before it looks at what lies between."""
        alone = units
        if self.mark:
            text, number = self.mark
            joined = [u for u in units if u and text[0] not in u]
            alone = [u for u in units if not u or text[0] in u]
            parts = [joined[i:i + 256] for i in range(0, len(joined), 256)]
            found = self.tok.encode_batch_fast([text.join(map(self._plain, part)) for part in parts],
                                               add_special_tokens=False)
            for part, got in zip(parts, found):
                ids = np.asarray(got.ids, "<u4")
                cut = np.flatnonzero(ids == number)
                if len(cut) != len(part) - 1:
                    alone += part
                    continue
                raw, at = ids.tobytes(), 0
                for u, end in zip(part, [*cut.tolist(), len(ids)]):
                    self.memo[u] = raw[4 * at:4 * end]
                    at = end + 1
        found = self.tok.encode_batch_fast([self._plain(u) if u else "" for u in alone],
                                           add_special_tokens=False)
        self.memo.update((u, np.asarray(e.ids, "<u4").tobytes()) for u, e in zip(alone, found))

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        block: list[tuple[str, bool]] = []
        size = 0

        def flush():
            nonlocal size
            for (_, first), ids in zip(block, self._block(block)):
                if first:
                    out.append(ids)
                else:
                    out[-1] += ids
            block.clear()
            size = 0

        for text in texts:
            for piece in self._pieces(text):
                block.append(piece)
                size += len(piece[0])
                if size >= self.block_chars:
                    flush()
        flush()
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(path)
