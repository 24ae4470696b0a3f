"""Token ids of the public byte-level BPE vocabulary, and flat token files.

Ids equal those of ``tokenizers`` with the same vocabulary.  Texts of printable ASCII and Latin letters go
through the rank form of the vocabulary, which is several times faster; any other text goes through
``tokenizers`` itself, so that no difference between the two libraries' Unicode tables can matter.
"""

from __future__ import annotations

import base64
import re

import numpy as np

VOCABULARY = "byte_bpe_50k"
#: The vocabulary's end-of-text id, which no text yields where names of special tokens are plain text: it separates documents in flat files.
SEPARATOR = 50256
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-¬®-ſ]*")


class TextTokenizer:
    """Whole texts to numpy arrays of ids, no special tokens added.  ``folder``: where the vocabulary files lie.

    literal: a special token's name in a text is plain text, so its id occurs in no text; else it becomes that id, the
    default of ``tokenizers``.
    """

    def __init__(self, folder: str | None = None, vocabulary: str = VOCABULARY, literal: bool = True):
        import public_tokenizers as public
        import tiktoken
        from tokenizers import Tokenizer

        at = (lambda n: f"{folder}/{n}") if folder else public.path
        self.exact = Tokenizer.from_file(at(f"{vocabulary}.json"))
        self.exact.encode_special_tokens = literal
        self.special = () if literal else tuple(t.content for t in self.exact.get_added_tokens_decoder().values())
        with open(at(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), np.uint32)
        return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
