"""Byte-level BPE ids of whole texts, shared by token counts and packing.

A tokenizers file of plain byte-level BPE (the GPT-2 pattern, no normalizer)
is loaded into tiktoken's encoder, which gives the same ids several times
faster; special-token strings in a text become their special ids, as the
tokenizers library's default has it. Files of another kind raise.

The encoder's pattern walks back through a run of white space and gives up on
very long ones. Such a run is cut out first: before a character that is not
white space all but its last character form one pre-token, at the end of a
text (or before a special token) the whole run does, so the ids are the same.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np

from zonecast.llm.bpe import _byte_symbols

#: Pre-token pattern of byte-level BPE files with ``use_regex``; fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: White space as the pattern's ``\\s`` has it; fixed value.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White-space runs of this many characters are merged on their own.
LONG_RUN = 50_000

_long_run = re.compile(f"(?<![{SPACE}])[{SPACE}]{{{LONG_RUN},}}")


class ByteBpe:
    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = (model["type"] == "BPE" and spec["normalizer"] is None and pre["type"] == "ByteLevel" and pre["use_regex"]
                 and not pre["add_prefix_space"] and not model["end_of_word_suffix"] and not model["ignore_merges"])
        if not plain:
            raise ValueError(f"{path}: not a plain byte-level BPE")
        byte = {s: bytes([b]) for b, s in enumerate(_byte_symbols())}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {b"".join(map(byte.__getitem__, t)): i for t, i in model["vocab"].items() if t not in self.special}
        self.encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)

    def _parts(self, text: str, special: bool) -> Iterator[tuple[str, bool]]:
        """The text in parts: (part, whether it is one pre-token by itself)."""
        start = 0
        for m in _long_run.finditer(text) if len(text) >= LONG_RUN else ():
            end = m.end()
            if end < len(text) and not (special and any(text.startswith(s, end) for s in self.special)):
                end -= 1
            yield text[start:m.start()], False
            yield text[m.start():end], True
            start = end
        yield text[start:], False

    def ids(self, text: str, special: bool = True) -> np.ndarray:
        """Ids of a text, uint32; with ``special`` the strings of special
        tokens become their ids, else they are ordinary text."""
        said = {"allowed_special": "all"} if special else {"disallowed_special": ()}
        if len(text) < LONG_RUN:
            return self.encoding.encode_to_numpy(text, **said)
        return np.concatenate([np.array(self.encoding._encode_single_piece(p), np.uint32) if single else self.encoding.encode_to_numpy(p, **said)
                               for p, single in self._parts(text, special)])

    def counts(self, texts: list[str]) -> list[int]:
        """Number of ids of each text, by one call of the encoder's batch form
        (texts that may hold a very long run one by one)."""
        out = [0] * len(texts)
        short = []
        for i, t in enumerate(texts):
            if len(t) < LONG_RUN:
                short.append(i)
            else:
                out[i] = len(self.ids(t))
        for i, ids in zip(short, self.encoding.encode_batch([texts[i] for i in short], num_threads=1, allowed_special="all")):
            out[i] = len(ids)
        return out


_loaded: dict[str, ByteBpe] = {}


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def load(path: str | None = None) -> ByteBpe:
    """The tokenizer of a file, read once per worker."""
    path = path or default_path()
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]
