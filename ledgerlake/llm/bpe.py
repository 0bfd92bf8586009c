"""BPE encoding by one dynamic program over prefixes, and decoding.

For each prefix of a pre-token exactly one token can end its encoding. The
tokens that end at a place come from a suffix automaton over the vocabulary,
longest first; the first one that is compatible with the last token of the
prefix before it is the answer. Following these back from the end gives the ids.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.arrow import record_batch
from ledgerlake.llm.vocabulary import Vocabulary, vocabulary

KNOWN_LIMIT = 800_000
PAIR_LIMIT = 2_000_000


class Automaton:
    """States are prefixes of tokens; each knows its longest proper suffix that is one too."""

    def __init__(self, pieces: dict[bytes, int]):
        self.go: list[dict[int, int]] = [{}]
        token = [-1]
        for piece, token_id in pieces.items():
            state = 0
            for byte in piece:
                following = self.go[state].get(byte)
                if following is None:
                    following = self.go[state][byte] = len(self.go)
                    self.go.append({})
                    token.append(-1)
                state = following
            token[state] = token_id
        self.suffix = [0] * len(self.go)
        # Per state the tokens that end there, longest first, each with its length.
        self.ends: list[tuple] = [()] * len(self.go)
        queue = deque([(0, 0)])
        while queue:
            state, depth = queue.popleft()
            for byte, child in self.go[state].items():
                if state:
                    back = self.suffix[state]
                    while back and byte not in self.go[back]:
                        back = self.suffix[back]
                    self.suffix[child] = self.go[back].get(byte, 0)
                own = ((token[child], depth + 1),) if token[child] >= 0 else ()
                self.ends[child] = own + self.ends[self.suffix[child]]
                queue.append((child, depth + 1))


class Encoder:
    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.automaton = Automaton(vocab.ids)
        # Merge order as token ids: a merged token is younger than its parts.
        self.rank = {int(t): n for n, t in enumerate(vocab.merged)}
        self.pairs = {
            (int(a), int(b)): n for n, (a, b) in enumerate(zip(vocab.left, vocab.right))
        }
        self.parts = {int(t): (int(a), int(b)) for t, a, b in zip(vocab.merged, vocab.left, vocab.right)}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        self.special = {s: np.array([i], "<u4").tobytes() for s, i in vocab.special.items()}
        self.pieces = [vocab.pieces.get(i, b"") for i in range(vocab.size)]

    def compatible_pair(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their joined text is merged.

        Both are taken apart step by step, the younger first. A pair that faces
        each other across the border would have been merged if its rank is lower
        than that of the merge being taken back.
        """
        rank, limit = self.rank, len(self.rank)
        while True:
            joint = self.pairs.get((left, right))
            if joint is not None and joint < limit:
                return False
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                # Equal ranks merge from the left, so the left token's merge came before.
                limit, left = a, self.parts[left][1]
            else:
                limit, right = b + 1, self.parts[right][0]

    def encode(self, pre_token: bytes) -> list[int]:
        go, suffix, ends = self.automaton.go, self.automaton.suffix, self.automaton.ends
        compatible, last, state = self.compatible, [], 0
        if len(compatible) > PAIR_LIMIT:
            compatible.clear()
        for place, byte in enumerate(pre_token, 1):
            while state and byte not in go[state]:
                state = suffix[state]
            state = go[state].get(byte, 0)
            for token, length in ends[state]:
                before = place - length
                if not before:
                    break
                pair = (last[before - 1][0], token)
                fits = compatible.get(pair)
                if fits is None:
                    fits = compatible[pair] = self.compatible_pair(*pair)
                if fits:
                    break
            else:
                raise ValueError(f"no token ends at byte {place} of {pre_token!r}")
            last.append((token, length))
        ids, place = [], len(pre_token)
        while place:
            token, length = last[place - 1]
            ids.append(token)
            place -= length
        return ids[::-1]

    def text_ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        known, special = self.known, self.special
        if len(known) > KNOWN_LIMIT:
            known.clear()
        tokens = self.vocab.pre_tokens(text)
        for t in set(tokens).difference(known):
            known[t] = special.get(t) or np.array(self.encode(t.encode()), "<u4").tobytes()
        return b"".join(map(known.__getitem__, tokens))

    def decode(self, ids: bytes) -> bytes:
        text = b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return text.decode("utf-8", "replace").encode()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(vocabulary(path))


def encode_batches(
    batches: Iterator[pa.RecordBatch], vocab_path: str, schema: pa.Schema, digest: bool, rows: int = 128
) -> Iterator[pa.RecordBatch]:
    own = encoder(vocab_path)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            part = batch.slice(begin, rows)
            ids = [own.text_ids(t or "") for t in part.column(1).to_pylist()]
            if digest:
                columns = [[len(x) // 4 for x in ids], [sha(x) for x in ids], [sha(own.decode(x)) for x in ids]]
            else:
                columns = [ids, [own.decode(x).decode() for x in ids]]
            yield record_batch(schema, [part.column(0), *columns])


def _apply(docs: DataFrame, vocab_path: str, id_column: str, text_column: str, columns: str, digest: bool):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, {columns}"
    run = partial(
        encode_batches, vocab_path=vocab_path, digest=digest,
        schema=to_arrow_schema(StructType.fromDDL(schema)),
    )
    return docs.select(id_column, text_column).mapInArrow(run, schema)


def bpe_round_trip(
    docs: DataFrame, vocab_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """`ids` (packed little-endian unsigned 32-bit integers) and the `decoded` text of every text.

    Null and empty texts have no ids and decode to the empty text. Repeated rows and
    null ids are kept as they are, an empty table gives an empty result, further
    columns play no part. Time is linear in the length of a pre-token, so texts
    without any space need no special care. `vocab_path` must be readable on every
    executor. Nothing is shuffled.
    """
    return _apply(docs, vocab_path, id_column, text_column, "ids binary, decoded string", False)


def bpe_digests(
    docs: DataFrame, vocab_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """As `bpe_round_trip`, with n_tokens and SHA-256 digests in place of ids and text."""
    columns = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _apply(docs, vocab_path, id_column, text_column, columns, True)
