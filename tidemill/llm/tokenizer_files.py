"""Tokenizer files of three public formats behind one small interface."""

from __future__ import annotations

import base64
import json
import os
import re
import struct
from collections.abc import Callable

import numpy as np

# Between two ASCII letters a single space always starts a new word, whatever follows: the pattern splitters
# used here match at most one space, and only in front of a word; no special string holds a space.
SAFE_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")

# fixed values: characters that all versions of Unicode count as letters, as numbers, as neither, or as white space
LETTER_CHARS = "A-Za-zÀ-ÖØ-öø-ÿА-яぁ-ゖァ-ヺ一-龥가-힣"
NUMBER_CHARS = "0-9"
OTHER_CHARS = "!\"#$%&()*+,\\-./:;<=>?@\\[\\]^_`{|}~、。「」，！？；：（）"
SPACE_CHARS = " \\t\\n\\r"

# Where words are runs of letters, of numbers or of neither, with at most one space before, a word ends where the class
# changes. An apostrophe is left out before letters, as it may begin a short ending.
CLASS_CUT = re.compile(
    f"(?<=[{LETTER_CHARS}{NUMBER_CHARS}{OTHER_CHARS}'])(?=[{SPACE_CHARS}])|(?<=[{LETTER_CHARS}])(?=[{NUMBER_CHARS}{OTHER_CHARS}'])"
    f"|(?<=[{NUMBER_CHARS}])(?=[{LETTER_CHARS}{OTHER_CHARS}'])|(?<=[{OTHER_CHARS}])(?=[{LETTER_CHARS}{NUMBER_CHARS}])"
)


def safe_pieces(text: str, size: int, cuts: re.Pattern = SAFE_CUT, whole: tuple[str, ...] = ()) -> list[str]:
    """Pieces of about `size` characters, cut only where no token can cross; longer where there is no such place.

    No string of `whole` is cut through.
    """
    out, start = [], 0
    while len(text) - start > size:
        at = start + size
        while (cut := cuts.search(text, at)) is not None and any(
            w in text[max(start, cut.start() - len(w) + 1) : cut.start() + len(w) - 1] for w in whole
        ):
            at = cut.start() + 1
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    out.append(text[start:])
    return out


class Encoder:
    """encode(texts) -> a list of token ids per text.

    `can_cut` says whether safe_pieces may be used before, `words_apart` whether spaces only separate words: then a
    text's ids are those of its words, one after the other.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[list[int]]],
        count: Callable[[list[str]], list[int]],
        can_cut: bool,
        words_apart: bool = False,
        placed: Callable[[str], tuple[list[int], np.ndarray]] | None = None,
        model: Callable[[str], list[int]] | None = None,
        cuts: re.Pattern = SAFE_CUT,
        whole: tuple[str, ...] = (),
    ):
        self.encode, self.count, self.can_cut, self.words_apart = encode, count, can_cut, words_apart
        self.cuts, self.whole = cuts, whole  # where a text may be cut, and what may not be cut through
        self.model = model  # ids of one lower-case word of plain letters, if the file treats those alone
        self.placed = placed  # ids of one text and the character each token starts at


def _drops_spaces(config: dict) -> bool:
    """Whether the file keeps only what its pattern matches, the pattern matches no white space, and neither the
    normalizer nor a special string looks beyond a space."""
    normalizer = (config.get("normalizer") or {}).get("normalizers") or []
    steps = (config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        all(step["type"] in ("NFC", "Lowercase", "Replace") for step in normalizer)
        and steps[0].get("type") == "Split"
        and steps[0].get("behavior") == "Removed"
        and steps[0].get("invert") is True
        and re.search(r" |\\s(?!\\p)", steps[0]["pattern"].get("Regex", " ")) is None
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in config["added_tokens"])
    )


# fixed value: a pattern under which a run of letters and a mark after it are always words of their own
LETTERS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


LETTERS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)")


def _classes_apart(config: dict) -> bool:
    """Whether words are runs of one class of characters and nothing looks beyond a word."""
    steps = config.get("pre_tokenizer") or {}
    return (
        not config.get("normalizer")
        and steps.get("type") == "ByteLevel"
        and steps.get("use_regex") is True
        and steps.get("add_prefix_space") is False
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in config["added_tokens"])
    )


class WordMemory:
    """Packed ids of texts for an encoder whose words stand apart: each new word is encoded once.

    Where the file lower-cases and its pattern parts letters from marks, a word of plain letters goes straight to the
    library's model, and "The", "the" and "the," share its answer. These letters have one composed form each, and
    one lower-case letter. All other words take the library's whole way.
    """

    LIMIT = 1_300_000

    def __init__(self, encoder: Encoder, kind: str):
        self.encoder, self.kind = encoder, kind
        self.known: dict[str, bytes] = {"": b""}
        self.cores: dict[str, bytes] = {}
        self.marks = dict(zip(["", *".,;:!?"], [b"", *self._encoded(list(".,;:!?"))], strict=True))

    def packed(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.LIMIT:
            self.known = {"": b""}
            self.cores = {}
        known, cores, marks, model = self.known, self.cores, self.marks, self.encoder.model
        letter = "H" if np.dtype(self.kind).itemsize == 2 else "I"
        pack = lambda ids: struct.pack(f"<{len(ids)}{letter}", *ids)
        split = [t.replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        new = set().union(*split).difference(known)
        others = []
        for word in new:
            found = LETTERS.fullmatch(word) if model else None
            if found is None:
                others.append(word)
                continue
            core = found[1].lower()
            ids = cores.get(core)
            if ids is None:
                ids = cores[core] = pack(model(core))
            known[word] = ids + marks[found[2]]
        for lo in range(0, len(others), 4096):
            some = others[lo : lo + 4096]
            known.update(zip(some, self._encoded(some), strict=True))
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        for word in new:
            if len(word) > 64:
                del known[word]
                cores.pop(word.lower(), None)
        return out

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word: the words go to the library as one text, and the tokens' places tell whose they are."""
        starts = np.cumsum([0] + [len(w) + 1 for w in words])
        ids, places = self.encoder.placed(" ".join(words))
        cuts = (np.searchsorted(places, starts) * np.dtype(self.kind).itemsize).tolist()
        packed = np.array(ids, self.kind).tobytes()
        return [packed[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def load(blob: bytes, suffix: str, pattern: str | None = None) -> Encoder:
    """An encoder without begin, end or added special tokens, without truncation or padding."""
    if suffix == ".json":
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        t = Tokenizer.from_buffer(blob)
        t.no_truncation()
        t.no_padding()

        def found(texts: list[str]):
            return t.encode_batch_fast(texts, add_special_tokens=False)

        def placed(text: str) -> tuple[list[int], np.ndarray]:
            e = t.encode(text, add_special_tokens=False)
            return e.ids, np.array([start for start, _ in e.offsets], np.int64)

        kind, config = type(t.pre_tokenizer).__name__, json.loads(blob)
        letters_apart = (
            _drops_spaces(config)
            and config["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex") == LETTERS_APART
            and any(step["type"] == "Lowercase" for step in config["normalizer"]["normalizers"])
        )
        shown = {}  # how the library writes each letter's bytes
        if letters_apart:
            shown = {ord(c): t.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in map(chr, range(256)) if LETTERS.fullmatch(c)}

        def model(word: str) -> list[int]:
            return [token.id for token in t.model.tokenize(word if word.isascii() else word.translate(shown))]

        return Encoder(
            lambda texts: [e.ids for e in found(texts)],
            lambda texts: [len(e) for e in found(texts)],
            kind in ("ByteLevel", "Sequence"),
            _drops_spaces(config),
            placed,
            model if letters_apart else None,
            CLASS_CUT if _classes_apart(config) else SAFE_CUT,
            tuple(token["content"] for token in config["added_tokens"]),
        )
    if suffix == ".model":
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_proto=blob)
        many = lambda texts: m.encode(texts, num_threads=1)
        return Encoder(many, lambda texts: [len(x) for x in many(texts)], False)
    if suffix == ".tiktoken":
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, blob.splitlines())}
        e = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        many = lambda texts: [e.encode_ordinary(x) for x in texts]
        return Encoder(many, lambda texts: [len(x) for x in many(texts)], True)
    raise ValueError(f"unknown tokenizer file {suffix}")


def vocabulary_size(blob: bytes, suffix: str) -> int:
    """One more than the largest id."""
    if suffix == ".json":
        config = json.loads(blob)
        return 1 + max([*config["model"]["vocab"].values(), *(t["id"] for t in config["added_tokens"])])
    if suffix == ".model":
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=blob).get_piece_size()
    return 1 + max(int(line.split()[1]) for line in blob.splitlines())


_LOADED: dict[tuple, Encoder] = {}


def loaded(blob: bytes, suffix: str, pattern: str | None = None) -> Encoder:
    """The encoder of a file, built once per Python worker."""
    key = (hash(blob), suffix, pattern)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = load(blob, suffix, pattern)
    return _LOADED[key]


_MEMORIES: dict[tuple, WordMemory] = {}


def memory(encoder: Encoder, kind: str) -> WordMemory:
    """The word memory of an encoder, kept between the tasks of a Python worker."""
    key = (id(encoder), kind)
    if key not in _MEMORIES:
        _MEMORIES.clear()
        _MEMORIES[key] = WordMemory(encoder, kind)
    return _MEMORIES[key]
