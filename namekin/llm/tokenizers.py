"""Public vocabularies, read on the driver and shipped to the tasks as bytes.

The folder is a parameter; the files are small and of fixed size.
"""

from __future__ import annotations

import base64
import os
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLDER = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
#: Splits text before the merges of the byte-level vocabulary (fixed value of that vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary(name: str, folder: str = FOLDER) -> bytes:
    with open(os.path.join(folder, name), "rb") as file:
        return file.read()


def byte_encoder(data: bytes):
    """Encoder of a rank file; its ids are the ranks, the next id is free for an end mark."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def end_mark(data: bytes) -> int:
    return len(data.splitlines())
