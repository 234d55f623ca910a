"""Byte-level BPE ids of a tokenizer file, as fast as the box allows.

The ids are those of `tokenizers` with add_special_tokens=False. Where the file is a plain byte-level
BPE whose merge ranks are its ids, the same ids come from the tiktoken engine (about five times
faster); `ByteBpe.check` compares both on given texts, and any other file, and any text that the fast
engine refuses, is read by `tokenizers`.
"""

from __future__ import annotations

import json
from functools import lru_cache

#: The split pattern of byte-level BPE files without a pattern of their own.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that byte-level BPE files write for each byte: itself if printable, else the next one from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Encoder of one tokenizer file's content."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        self._content, self._slow, self._fast = content, None, None
        if self._plain(spec):
            import tiktoken

            letters = byte_letters()
            special = {x["content"]: x["id"] for x in spec.get("added_tokens") or [] if x.get("special")}
            ranks = {bytes(letters[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
            self._fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
            self._special = set(special)

    @staticmethod
    def _plain(spec: dict) -> bool:
        """Whether tiktoken's rules are this file's rules: no normaliser, standard split, ids in merge order."""
        model, pre, letters = spec["model"], spec.get("pre_tokenizer") or {}, byte_letters()
        added = spec.get("added_tokens") or []
        if model.get("type", "BPE") != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            return False
        if model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
            return False
        if any(not x.get("special") or x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in added):
            return False
        vocab, names = model["vocab"], {x["content"] for x in added}
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        return all(c in vocab for c in letters) and all(set(p) <= set(letters) for p in vocab if p not in names) and all(vocab[a] < vocab[b] for a, b in zip(merged, merged[1:], strict=False)) and len(merged) + 256 + len(names & vocab.keys()) == len(vocab)

    def slow(self, text: str) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_str(self._content.decode())
        return self._slow.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> list[int]:
        if self._fast is None:
            return self.slow(text)
        try:
            return self._fast.encode(text, allowed_special=self._special, disallowed_special=())
        except ValueError:  # its pattern engine gives up on runs of white space of about a million characters
            return self.slow(text)

    def check(self, texts: list[str]) -> bool:
        return all(self(x) == self.slow(x) for x in texts)


@lru_cache(maxsize=2)
def encoder(content: bytes) -> ByteBpe:
    return ByteBpe(content)
