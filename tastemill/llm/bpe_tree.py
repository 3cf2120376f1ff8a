"""BPE encoding and decoding by tree concatenation.

A text is cut into pieces at points where the tokenizer is known to cut as well
(a space before a visible character always begins a new token), so these joins
need no repair. What stays together is unsplit text. If it is long, it is halved
down to leaves, the leaves are encoded side by side, and the halves are joined
again from the leaves up: around each join a window of tokens is encoded anew,
and the window grows until its first token is the left side's own token and its
last one the right side's. All neighbours in the joined list are then neighbours
in some exact encoding, which for BPE makes the whole list the exact encoding.
Time is linear in the text's length but for the joins, which are short.

As words repeat, each different piece of a batch of texts is encoded once.

Defined results: a null text counts as empty; an empty text has no ids and
decodes to an empty text; every row is encoded by itself, so repeated rows give
repeated results; columns beyond ``doc_id`` and ``text`` are passed by.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tastemill.llm.common import Batches, give_back, id_and_text, in_slices, list_array

LEAF = 256
#: Length of the strings of short pieces that are encoded in one call.
STRING = 100_000
#: A space before a character that no definition counts as white space.
CUT = re.compile(r" (?=[\w!-~])")
#: Finds texts with a space that is no such cut; in the syntax of Arrow's expressions.
UNSAFE = r" ([^\p{L}\p{N}!-~]|\z)"
#: Fixed value: how this kind of tokenizer file cuts text (the published pattern of its "use_regex").
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class TreeEncoder:
    """Exact ids of texts for a byte-level BPE tokenizer file."""

    def __init__(self, path: str, leaf: int = LEAF):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        #: The same model on text that is already in the byte alphabet: no cuts at all.
        self.bare = Tokenizer(self.tokenizer.model)
        self.leaf = max(2, leaf)
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: i for i, t in added.items()}
        self.plain_added = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values())
        longest_first = sorted(self.added, key=len, reverse=True)
        self.at_added = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        self.cuts = self.plain_added and not any(" " in t for t in self.added)
        #: Made once for both ways: what a worker keeps, it keeps through all later stages.
        self.decoder = Decoder(path, self.tokenizer)
        bytes_of = self.decoder.bytes_of
        self.n_bytes = np.array([len(b) for b in bytes_of], dtype=np.int64)
        self.ranks = _rank_encoder(path, bytes_of, set(self.added.values()))

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        if not len(texts):
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        # The first piece of a text has no space before it: a NUL marks it.
        empty, nul = (pa.scalar(c, pa.large_string()) for c in ("", "\0"))
        marked = pc.binary_join_element_wise(empty, texts, nul)
        if not self.cuts:
            pieces = pa.LargeListArray.from_arrays(np.arange(len(texts) + 1), marked)
        elif pc.any(odd := pc.match_substring_regex(texts, UNSAFE)).as_py():
            split = [CUT.split(t) if o else t.split(" ") for t, o in zip(marked.to_pylist(), odd.to_pylist())]
            pieces = pa.array(split, pa.large_list(pa.large_string()))
        else:
            pieces = pc.split_pattern(marked, " ")
        n_pieces = pc.list_value_length(pieces).to_numpy()
        coded = pieces.flatten().dictionary_encode()
        ids, lengths = self.encode_pieces(coded.dictionary)
        which = coded.indices.to_numpy()
        per_piece = lengths[which]
        ends = np.concatenate([[0], np.cumsum(per_piece)])
        # Where every output id stands among the pieces' ids: its piece's start plus its place in the piece.
        own_start = np.cumsum(lengths) - lengths
        at = np.repeat(own_start[which] - ends[:-1], per_piece) + np.arange(ends[-1])
        last = np.cumsum(n_pieces)
        return ids[at], ends[last] - ends[last - n_pieces]

    def encode_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different pieces, one after the other, and their numbers.

        Short pieces are strung together with the spaces between them, as the
        string is cut there anyway: one call instead of one for each.
        """
        sizes = pc.binary_length(pieces).to_numpy()
        alone = (sizes >= self.leaf) | pc.starts_with(pieces, "\0").to_numpy(zero_copy_only=False)
        for token in self.added:
            alone |= pc.match_substring(pieces, token).to_numpy(zero_copy_only=False)
        if not self.cuts:
            alone[:] = True
        rest = pieces.filter(pa.array(~alone))
        lengths = np.zeros(len(pieces), dtype=np.int64)
        found: list[np.ndarray] = []
        if len(rest):
            string, lengths[~alone] = self._encode_string(rest, sizes[~alone])
            found.append(string)
        for i, piece in zip(np.flatnonzero(alone).tolist(), pieces.filter(pa.array(alone)).to_pylist()):
            text = piece[1:] if piece.startswith("\0") else " " + piece
            short = len(text) <= self.leaf
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids if short else self.encode_unsplit(text)
            lengths[i] = len(ids)
            found.append(np.array(ids, dtype=np.uint32))
        # Back to the order of the pieces.
        flat = np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)
        order = np.concatenate([np.flatnonzero(~alone), np.flatnonzero(alone)])
        starts = np.empty(len(pieces), dtype=np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        begin = np.cumsum(lengths) - lengths
        return flat[np.repeat(starts - begin, lengths) + np.arange(lengths.sum())], lengths

    def _encode_string(self, pieces: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of short pieces, each taken with a space before it."""
        if self.ranks is not None:
            rare = pc.match_substring_regex(pieces, "[^\\x{0}-\\x{24F}]").to_numpy(zero_copy_only=False)
        else:
            rare = np.ones(len(pieces), dtype=bool)
        parts, lengths, space = [], np.zeros(len(pieces), dtype=np.int64), pa.scalar(" ", pa.large_string())
        for group in (~rare, rare):
            texts, per_piece, every = pieces.filter(pa.array(group)), [], max(1, STRING // 8)
            for i in range(0, len(texts), every):
                some = texts[i : i + every]
                string = " " + pc.binary_join(pa.LargeListArray.from_arrays([0, len(some)], some), space)[0].as_py()
                if group is rare:
                    ids = np.array(self.tokenizer.encode(string, add_special_tokens=False).ids, dtype=np.int64)
                else:
                    ids = self.ranks.encode_to_numpy(string).astype(np.int64)
                ends = np.cumsum(sizes[group][i : i + every] + 1)
                token_ends = np.cumsum(self.n_bytes[ids])
                stops = np.searchsorted(token_ends, ends)
                if not np.array_equal(token_ends[stops], ends):
                    raise ValueError("this tokenizer joins pieces across a space")
                per_piece.append(np.diff(stops + 1, prepend=0))
                parts.append(ids.astype(np.uint32))
            if per_piece:
                lengths[group] = np.concatenate(per_piece)
        flat = np.concatenate(parts)
        order = np.concatenate([np.flatnonzero(~rare), np.flatnonzero(rare)])
        starts = np.empty(len(pieces), dtype=np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        begin = np.cumsum(lengths) - lengths
        return flat[np.repeat(starts - begin, lengths) + np.arange(lengths.sum())], lengths

    def encode_unsplit(self, text: str) -> list[int]:
        """Ids of a text that offers no known cut."""
        if not self.plain_added:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        ids: list[int] = []
        for part in self.at_added.split(text) if self.at_added else [text]:
            if part in self.added:
                ids.append(self.added[part])
            elif part:
                for token, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                    ids += self._tree(token)
        return ids

    def _tree(self, text: str) -> list[int]:
        """Ids of one run of the byte alphabet."""
        leaves = [text[i : i + self.leaf] for i in range(0, len(text), self.leaf)]
        # One call for all leaves: the library encodes the items of a batch in parallel.
        sides = [(e.ids, e.tokens) for e in self.bare.encode_batch(leaves, add_special_tokens=False)]
        while len(sides) > 1:
            joined = [self._join(a, b) for a, b in zip(sides[::2], sides[1::2])]
            sides = joined + sides[len(joined) * 2 :]
        return sides[0][0]

    def _join(self, left: tuple[list, list], right: tuple[list, list]) -> tuple[list, list]:
        (ids_a, text_a), (ids_b, text_b) = left, right
        width = 4
        while True:
            a, b = max(0, len(ids_a) - width), min(len(ids_b), width)
            window = self.bare.encode("".join(text_a[a:] + text_b[:b]), add_special_tokens=False)
            starts = a == 0 or window.ids[0] == ids_a[a]
            ends = b == len(ids_b) or window.ids[-1] == ids_b[b - 1]
            if starts and ends and (len(window.ids) > 1 or (a == 0 and b == len(ids_b))):
                return ids_a[:a] + window.ids + ids_b[b:], text_a[:a] + window.tokens + text_b[b:]
            width *= 2


def _rank_encoder(path: str, bytes_of: list[bytes], added: set[int]):
    """A faster encoder for short pieces, if merge order and id order agree in the file; else None."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    model, cut = held["model"], held.get("pre_tokenizer") or {}
    vocab, first = model["vocab"], 256
    in_order = all(
        vocab.get((m if isinstance(m, str) else " ".join(m)).replace(" ", "")) == first + k
        for k, m in enumerate(model["merges"])
    )
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    if not (in_order and plain and held.get("normalizer") is None and not model.get("ignore_merges")):
        return None
    ranks = {bytes_of[i]: i for i in vocab.values() if i not in added}
    return tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})


class Decoder:
    """Text of ids for a byte-level tokenizer file (or the tokenizer made of it); special tokens are kept."""

    def __init__(self, path: str, tokenizer=None):
        from tokenizers import Tokenizer

        tokenizer = tokenizer or Tokenizer.from_file(path)
        shown = [b for r in ((33, 126), (161, 172), (174, 255)) for b in range(r[0], r[1] + 1)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        vocab = tokenizer.get_vocab()
        self.bytes_of: list[bytes] = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            known = all(c in byte_of for c in token)
            self.bytes_of[i] = bytes(byte_of[c] for c in token) if known else token.encode()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_ENCODERS: dict[tuple, TreeEncoder] = {}


def encoder(path: str, leaf: int = LEAF) -> TreeEncoder:
    """The worker's encoder for a tokenizer file, kept from task to task."""
    if (path, leaf) not in _ENCODERS:
        _ENCODERS[(path, leaf)] = TreeEncoder(path, leaf)
        # The file's text and tables are needed to build it only.
        give_back()
    return _ENCODERS[(path, leaf)]


def decoder(path: str, leaf: int = LEAF) -> Decoder:
    return encoder(path, leaf).decoder


def encode_decode(docs: DataFrame, tokenizer_path: str, leaf: int = LEAF) -> DataFrame:
    """``doc_id, ids array<int>, decoded string`` of every row: its ids, and the text made from them alone."""

    def run(batches: Batches) -> Batches:
        to_ids, to_text = encoder(tokenizer_path, leaf), decoder(tokenizer_path, leaf)
        for batch in in_slices(batches):
            ids, lengths = to_ids.encode(batch.column("text"))
            ends = np.cumsum(lengths)
            decoded = [to_text.decode(ids[e - n : e].tolist()) for e, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), list_array(ids.astype(np.int32), lengths), pa.array(decoded, pa.string())],
                ["doc_id", "ids", "decoded"],
            )

    frame = id_and_text(docs)
    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
