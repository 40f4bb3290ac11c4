"""Token ids by the vocabulary files of public tokenizers; the file's path is a parameter."""

from __future__ import annotations

import base64
import os
import re

import numpy as np

#: Code points over which both libraries were compared (tests/llm) and agree.
_COMPARED = re.compile("[^\x00-ɏ]")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def vocabulary_size(path: str) -> int:
    """One more than the largest id, added tokens included."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()) + 1


class Encoder:
    """Ids of whole texts, as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` gives them.

    ``tokenizers`` reads the JSON file. Where a rank file of the same name
    and vocabulary lies beside it, ``tiktoken`` encodes the texts for which
    both give the same ids; it takes about a third of the time. It knows no
    added tokens, so a text that holds the string of one goes to
    ``tokenizers``, which gives that token's id; so do texts with very long
    runs of white space, on which it gives up.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._slow = Tokenizer.from_file(path)
        self._fast = None
        ranks = f"{os.path.splitext(path)[0]}.tiktoken"
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._added = [t.content for t in self._slow.get_added_tokens_decoder().values()]
            self._fast = tiktoken.Encoding(os.path.basename(ranks), pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        plain = self._fast is not None and not any(x in text for x in self._added)
        if plain and (text.isascii() or not _COMPARED.search(text)):
            try:
                return self._fast.encode_to_numpy(text, disallowed_special=())
            except ValueError:  # its pattern needs more stack than there is
                pass
        return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)
