"""Tokenizers inside tasks: one instance per worker and vocabulary file."""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Callable
from functools import cache


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """The installed vocabulary file of that name; its path is a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def encoder(path: str) -> Callable[[str], list[int]]:
    """text -> ids, without special tokens.

    A ``.json`` file is read by ``tokenizers``. A ``.tiktoken`` file holds a
    byte-level vocabulary as ranks and is read by ``tiktoken``, which gives the
    same ids as the ``.json`` of the same vocabulary four times as fast. A
    ``.model`` file is read by ``sentencepiece``.
    """
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_file=path).encode
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.encode_special_tokens = True
        return lambda text: made.encode(text, add_special_tokens=False).ids
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    made = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return made.encode_ordinary


@cache
def contract_encoder(path: str) -> Callable[[str], list[int]]:
    """text -> ids as ``tokenizers`` gives them for the vocabulary's ``.json`` with add_special_tokens=False.

    Added tokens of the ``.json`` that stand in the text get their own ids. For
    a ``.tiktoken`` file the ``.json`` of the same name beside it lists them:
    the text is split at them and the parts are read by the faster ``encoder``.
    """
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        return lambda text: made.encode(text, add_special_tokens=False).ids
    listing, plain = f"{path.removesuffix('.tiktoken')}.json", encoder(path)
    if not os.path.exists(listing):
        return plain
    with open(listing, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        return contract_encoder(listing)  # these match by more than their text
    ids = {t["content"]: t["id"] for t in added}
    if not ids:
        return plain
    # The leftmost match, and of several the longest.
    split = re.compile("(" + "|".join(map(re.escape, sorted(ids, key=len, reverse=True))) + ")").split

    def encode(text: str) -> list[int]:
        parts = split(text)
        if len(parts) == 1:
            return plain(text)
        out: list[int] = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(ids[part])
            elif part:
                out += plain(part)
        return out

    return encode


@cache
def token_bytes(path: str) -> list[bytes]:
    """The bytes that each id stands for (empty where an id stands for none)."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        made = SentencePieceProcessor(model_file=path)
        pieces = [made.id_to_piece(i) for i in range(made.get_piece_size())]
        return [bytes([int(p[3:5], 16)]) if made.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)]
    if path.endswith(".json"):
        raise ValueError("give a byte-level vocabulary as its rank file")
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    return [ranks.get(i, b"") for i in range(max(ranks) + 1)]
