"""Token counts by rank-synchronous merging of ragged numpy arrays.

Distinct pre-tokens are held together as one flat array of symbols. In every
round each sequence looks up the merge ranks of its neighbouring symbols, takes
its lowest one and joins all places of that pair, in all sequences at once;
sequences without a pair are finished. What is left of each is its token count.
A round looks at all symbols, so a sequence of very many symbols, which takes very
many rounds, is merged in an array of its own, where a round touches only the places
of its rank and their neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.arrow import record_batch
from ledgerlake.llm.vocabulary import Vocabulary, vocabulary

NO_RANK = np.iinfo(np.int64).max
KNOWN_LIMIT = 1_000_000
LONG = 2_048  # bytes of a pre-token that is merged in an array of its own
_known: dict[tuple[str, str], dict[str, int]] = {}


def ranks_of(vocab: Vocabulary, pairs: np.ndarray) -> np.ndarray:
    at = np.searchsorted(vocab.pair_keys, pairs)
    at[at == len(vocab.pair_keys)] = 0
    return np.where(vocab.pair_keys[at] == pairs, vocab.pair_ranks[at], NO_RANK)


def long_count(vocab: Vocabulary, pre_token: bytes) -> int:
    """Tokens of one long pre-token.

    A merged symbol forms only pairs of higher rank than its own, so a rank that has
    been applied does not come back and its places can be gathered until its turn.
    """
    symbols = vocab.byte_ids[np.frombuffer(pre_token, np.uint8)]
    many = len(symbols)
    after, before = np.arange(1, many + 1), np.arange(-1, many - 1)
    rank = np.append(ranks_of(vocab, symbols[:-1] * vocab.size + symbols[1:]), NO_RANK)
    order = np.argsort(rank, kind="stable")
    order = order[: np.searchsorted(rank[order], NO_RANK)]
    known, starts = np.unique(rank[order], return_index=True)
    places = {r: [p] for r, p in zip(known.tolist(), np.split(order, starts[1:]))}
    waiting = list(places)
    heapify(waiting)
    left = many
    while waiting:
        lowest = heappop(waiting)
        at = np.unique(np.concatenate(places.pop(lowest)))
        at = at[rank[at] == lowest]
        # Pairs that overlap, as in a a a, are joined from the left.
        chain = np.append(False, after[at[:-1]] == at[1:]) if len(at) else np.zeros(0, bool)
        begin = np.maximum.accumulate(np.where(chain, 0, np.arange(len(at))))
        at = at[(np.arange(len(at)) - begin) % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        symbols[at] = vocab.merged[lowest]
        rank[gone] = NO_RANK
        after[at] = after[gone]
        inner = at[after[at] < many]
        before[after[inner]] = inner
        left -= len(at)
        # Removed places point nowhere; pairs of two joined places come up twice.
        changed = np.unique(np.concatenate([at, before[at]]))
        changed = changed[changed >= 0]
        rank[changed] = NO_RANK
        changed = changed[after[changed] < many]
        new = ranks_of(vocab, symbols[changed] * vocab.size + symbols[after[changed]])
        rank[changed] = new
        changed, new = changed[new != NO_RANK], new[new != NO_RANK]
        order = np.argsort(new, kind="stable")
        known, starts = np.unique(new[order], return_index=True)
        for r, p in zip(known.tolist(), np.split(changed[order], starts[1:])):
            if r not in places:
                places[r] = []
                heappush(waiting, r)
            places[r].append(p)
    return left


def merge_counts(vocab: Vocabulary, pre_tokens: list[bytes]) -> np.ndarray:
    """Tokens of every (non-empty) pre-token."""
    long = [n for n, t in enumerate(pre_tokens) if len(t) > LONG]
    if long:
        counts = np.zeros(len(pre_tokens), np.int64)
        counts[long] = [long_count(vocab, pre_tokens[n]) for n in long]
        short = [n for n, t in enumerate(pre_tokens) if len(t) <= LONG]
        if short:
            counts[short] = merge_counts(vocab, [pre_tokens[n] for n in short])
        return counts
    lengths = np.fromiter(map(len, pre_tokens), np.int64, len(pre_tokens))
    counts = lengths.copy()
    symbols = vocab.byte_ids[np.frombuffer(b"".join(pre_tokens), np.uint8)]
    owner = np.repeat(np.arange(len(pre_tokens)), lengths)
    while len(symbols) > 1:
        ranks = ranks_of(vocab, symbols[:-1] * vocab.size + symbols[1:])
        ranks = np.append(np.where(owner[:-1] == owner[1:], ranks, NO_RANK), NO_RANK)

        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        lowest = np.minimum.reduceat(ranks, starts)
        size = np.diff(np.append(starts, len(symbols)))
        chosen = ranks == np.repeat(lowest, size)
        chosen &= ranks != NO_RANK
        chosen = leftmost(chosen)

        joined = np.flatnonzero(chosen)
        symbols = symbols.copy()
        symbols[joined] = vocab.merged[ranks[joined]]
        keep = np.ones(len(symbols), bool)
        keep[joined + 1] = False
        counts -= np.bincount(owner[joined], minlength=len(counts))
        keep &= np.repeat(lowest != NO_RANK, size)
        symbols, owner = symbols[keep], owner[keep]
    return counts


def leftmost(chosen: np.ndarray) -> np.ndarray:
    """Of directly neighbouring chosen places (as in a a a) every second, from the left."""
    run_start = chosen & ~np.append(False, chosen[:-1])
    if run_start.sum() == chosen.sum():
        return chosen
    place = np.arange(len(chosen))
    begin = np.maximum.accumulate(np.where(run_start, place, 0))
    return chosen & ((place - begin) % 2 == 0)


def text_tokens(vocab: Vocabulary, texts: list[str], known: dict[str, int]) -> list[int]:
    split = [vocab.pre_tokens(text) for text in texts]
    new = list({t for tokens in split for t in tokens if t not in known})
    special = {s: 1 for s in vocab.special}
    plain = [t for t in new if t not in special]
    known.update(special)
    if plain:
        known.update(zip(plain, merge_counts(vocab, [t.encode() for t in plain]).tolist()))
    return [sum(map(known.__getitem__, tokens)) for tokens in split]


def count_batches(
    batches: Iterator[pa.RecordBatch], vocab_path: str, limit: int, schema: pa.Schema, rows: int = 256
) -> Iterator[pa.RecordBatch]:
    vocab = vocabulary(vocab_path)
    known = _known.setdefault((vocab_path, "counts"), {})
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            part = batch.slice(begin, rows)
            if len(known) > KNOWN_LIMIT:
                known.clear()
            texts = [t or "" for t in part.column(1).to_pylist()]
            n = text_tokens(vocab, texts, known)
            sizes = [len(t.encode()) for t in texts]
            yield record_batch(schema, [part.column(0), sizes, n, [x > limit for x in n]])


def token_counts(
    docs: DataFrame, vocab_path: str, id_column: str = "doc_id", text_column: str = "text",
    limit: int = 1024,
) -> DataFrame:
    """n_bytes, n_tokens and over_limit (more than `limit` tokens) of every whole text.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows and null ids are
    kept as they are, an empty table gives an empty result, further columns play no
    part. `vocab_path` must be readable on every executor. A worker remembers the
    counts of up to 1,000,000 pre-tokens and starts anew beyond; nothing is shuffled.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    run = partial(count_batches, vocab_path=vocab_path, limit=limit, schema=arrow)
    return docs.select(id_column, text_column).mapInArrow(run, schema)
