"""Token counts by a map-side two-tier lookup.

Where no piece of the vocabulary holds a space mark after another character,
merges never cross the gap before a space: a text's tokens are the tokens of
its space-led pre-tokens. Where no piece holds a newline either (it becomes one
byte piece), a newline starts a pre-token as well. Both are checked on the model
(splits_at_spaces); texts under a model without them are encoded whole. Tier one is a compact table
of frequent pre-tokens, learned from a bounded sample of rows and broadcast;
tier two encodes the misses in each worker and remembers them in a bounded
cache. Pre-tokens are never shuffled; results do not depend on either tier.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows
are counted row by row; a null id is returned as it is; extra columns are
dropped before the Python stage; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
_UNIT = re.compile(" *[^ ]+| +")
_processors: dict[str, object] = {}


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def processor(model_path: str):
    if model_path not in _processors:
        import sentencepiece

        _processors[model_path] = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return _processors[model_path]


def splits_at_spaces(sp) -> bool:
    """Whether no piece holds a space mark after another character, or a newline."""
    pieces = (sp.id_to_piece(i) for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
    return not any("\n" in p or MARK in p.lstrip(MARK) for p in pieces)


def pre_tokens(text: str) -> list[str] | None:
    """Pre-tokens of a text; a unit not led by a newline has an implied space before it.

    None where a text holds the space mark itself and must be encoded whole.
    """
    if MARK in text:
        return None
    cut = text.replace("\n", " \n")
    if "  " in cut or cut[-1:] == " " or cut[:1] == " ":
        units = []
        for i, line in enumerate(text.split("\n")):
            found = _UNIT.findall(line if i else " " + line)
            if i and (not found or found[0][0] != " "):
                units.append("\n" + (found.pop(0) if found else ""))
            elif i:
                units.append("\n")
            units += [u[1:] for u in found]
        return units
    return cut.split(" ") if cut else []


def encode_unit(sp, unit: str) -> list[int]:
    if unit[:1] == "\n":
        return sp.encode(unit, num_threads=1)[1:]  # without the implied space
    return sp.encode(unit, num_threads=1) if unit else sp.encode(" ", num_threads=1)[:0] + [sp.piece_to_id(MARK)]


def frequent_units(docs: DataFrame, text: str, sample_rows: int, entries: int, sample_chars: int = 16_384) -> list[str]:
    """The most frequent pre-tokens in the heads of some sample_rows rows, drawn from the whole table.

    What reaches the driver is bounded by both numbers.
    """
    seen: Counter = Counter()
    rows = docs.count()
    head = F.substring(F.col(text).cast("string"), 1, sample_chars).alias("text")
    drawn = docs.select(head).sample(fraction=min(1.0, sample_rows / max(rows, 1)), seed=5)
    for (t,) in drawn.where("text is not null").limit(2 * sample_rows).collect():
        seen.update(u for u in pre_tokens(t) or () if len(u) <= 64)
    return [u for u, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:entries]]


def count_tokens(
    docs: DataFrame,
    model_path: str | None = None,
    text: str = "text",
    id_col: str = "doc_id",
    limit: int = 4096,
    sample_rows: int = 1000,
    entries: int = 30_000,
    cache: int = 300_000,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    sample_rows and entries bound the broadcast first tier, cache the pre-tokens
    that a worker remembers; all three change the speed only.
    """
    path = model_path or default_model()
    sp = processor(path)
    whole = not splits_at_spaces(sp)
    first = [] if whole else frequent_units(docs, text, sample_rows, entries)
    shared = docs.sparkSession.sparkContext.broadcast({u: len(encode_unit(sp, u)) for u in first})
    rows = docs.select(F.col(id_col), F.col(text).cast("string").alias("text"))
    schema = rows.select(id_col).schema.add("n_bytes", "long").add("n_tokens", "long")
    return rows.mapInArrow(_counter(path, shared, cache, id_col, whole), schema).withColumn("over_limit", F.col("n_tokens") > limit)


def _counter(path: str, shared, cache: int, id_col: str, whole: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, first, second = processor(path), shared.value, {}
        for batch in batches:
            sizes, counts = [], []
            for t in batch.column(1).to_pylist():
                sizes.append(len(t.encode("utf-8", "surrogatepass")) if t else 0)
                units = [] if not t else None if whole else pre_tokens(t)
                if units is None:
                    counts.append(len(sp.encode(t, num_threads=1)))
                    continue
                got = [first.get(u) for u in units]
                n = 0
                for i, k in enumerate(got):
                    if k is None:
                        u = units[i]
                        k = second.get(u)
                        if k is None:
                            k = len(encode_unit(sp, u))
                            if len(u) <= 64:
                                if len(second) >= cache:
                                    second.clear()
                                second[u] = k
                    n += k
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=[id_col, "n_bytes", "n_tokens"]
            )

    return run
