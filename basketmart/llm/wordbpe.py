"""Token ids of whole texts by a word-level BPE file, with the ids of each word remembered.

The tokenizer drops white space and never joins across it, so a text's ids are those of its words in order. Unknown words
of a group of texts are found at once; those of letters only, which the tokenizer takes as they are, go to its merges
directly, the others are encoded together. Words are looked up in ASCII lower case, as the tokenizer lowers them itself;
texts that may hold a special token's spelling are left as they are.
"""

from __future__ import annotations

from struct import pack
from unicodedata import is_normalized

import numpy as np

from basketmart.llm.text import byte_chars

FILE = "word_bpe_49k.json"
REMEMBERED = 250_000  # words of a generation; two are kept
GROUP_BYTES = 2_000_000  # of texts whose words are looked up together; a longer text is a group of its own
_TAIL = b".,;:!?"
_BYTE = str.maketrans({chr(b): c for b, c in byte_chars().items()})
_KNOWN: dict[str, "WordIds"] = {}


def _ends_with_letter(word: bytes) -> bool:
    return word[-1:].isalnum() or (word[-1] > 127 and word.decode("utf-8", "replace")[-1].isalpha())


class WordIds:
    """``ids``: words of this generation, ``old``: of the one before; memory is bounded by the two."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.ids: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        """Make ``ids`` hold these words. The tokenizer never joins a letter with the punctuation after it, so a word's
        ids are those of what precedes its last punctuation, then those of that."""
        ids, old = self.ids, self.old
        parted, new = [], set()
        for w in words:
            if w in ids:
                continue
            if w in old:
                ids[w] = old[w]
                continue
            core = w.rstrip(_TAIL)
            if core and core != w and b"<|" not in w and _ends_with_letter(core):
                tail = w[len(core) :]
                parted.append((w, core, tail))
                for part in (core, tail):
                    if part in old:
                        ids[part] = old[part]
                    elif part not in ids:
                        new.add(part)
            else:
                new.add(w)
        new = [w for w in new if not self._merged(w)]
        for at in range(0, len(new), 20_000):
            self._encode_words(new[at : at + 20_000])
        for w, core, tail in parted:
            ids[w] = ids[core] + ids[tail]

    def _merged(self, word: bytes) -> bool:
        """Encode a word of nothing but lower-case letters in their usual form; otherwise say no."""
        if word.isalpha():
            plain = word.lower().decode()
        elif word.isascii():
            return False
        else:
            text = word.decode("utf-8", "replace")
            if not text.isalpha() or text != text.lower() or not is_normalized("NFC", text):
                return False
            plain = word.decode("latin-1").translate(_BYTE)
        made = self.model.tokenize(plain)
        self.ids[word] = pack(f"<{len(made)}I", *[t.id for t in made])
        return True

    def _encode_words(self, part: list[bytes]) -> None:
        encoded = self.tokenizer.encode(
            [w.decode("utf-8", "replace") for w in part], is_pretokenized=True, add_special_tokens=False
        )
        owner = encoded.word_ids
        if None in owner:  # a special token's spelling belongs to no word: one by one
            for w in part:
                own = self.tokenizer.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids
                self.ids[w] = np.array(own, "<u4").tobytes()
            return
        ids = np.array(encoded.ids, "<u4").tobytes()
        ends = np.searchsorted(np.array(owner, np.int64), np.arange(len(part)), "right") * 4
        start = 0
        for w, end in zip(part, ends.tolist()):
            self.ids[w] = ids[start:end]
            start = end

    def encode(self, bodies: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out, group, size = [], [], 0
        for body in bodies:
            if group and size + len(body) > GROUP_BYTES:
                out += self._look_up(group)
                group, size = [], 0
            group.append(body)
            size += len(body)
        return out + self._look_up(group)

    def _look_up(self, bodies: list[bytes]) -> list[bytes]:
        texts = [body.split() if b"<|" in body else body.lower().split() for body in bodies]
        if len(self.ids) > REMEMBERED:
            self.old, self.ids = self.ids, {}
        self.learn(set().union(*texts).difference(self.ids))
        ids = self.ids
        return [b"".join([ids[w] for w in words]) for words in texts]


def word_ids(path: str | None = None) -> WordIds:
    """The encoder of a file, kept by the Python worker. Without a path, the installed public file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(FILE)
    if path not in _KNOWN:
        _KNOWN[path] = WordIds(path)
    return _KNOWN[path]
