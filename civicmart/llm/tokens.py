"""Token counts of a piece vocabulary, without materialising ids.

No piece of such a vocabulary goes over from other text into a blank, so a text falls into pre-tokens
(blanks and what follows them) that are cut into pieces on their own. A task counts the pieces once
per distinct pre-token, looks the counts up for the pre-tokens of its documents and adds them up. The
lookup table belongs to the task and is emptied at a fixed size, so nothing is shuffled and memory
does not grow with the corpus.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from civicmart.llm.columns import distinct, flat, slices, sums

#: Distinct pre-tokens whose counts a task remembers at a time.
REMEMBERED = 300_000
SPACE = "▁"


class PieceCounter:
    """Counts the pieces of texts as the vocabulary's own library does."""

    def __init__(self, model: bytes, remembered: int = REMEMBERED):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces) or self.model.encode("  a", out_type=str)[0] != SPACE * 2:
            raise ValueError("pieces of this vocabulary go over blanks")
        if any("\n" in p for p in pieces) or self.model.encode("\n", out_type=str)[0] != SPACE:
            raise ValueError("pieces of this vocabulary hold line ends")
        self.known: dict[bytes, int] = {}
        self.remembered = remembered

    def of(self, tokens: list[bytes]) -> np.ndarray:
        """Pieces of each distinct pre-token. It begins with a blank, which the library adds itself, or a line end."""
        if len(self.known) > self.remembered:
            self.known.clear()
        new = [t for t in tokens if t not in self.known]
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            cut = [(t[1:] if t[:1] == b" " else t).decode("utf-8", "replace") for t in part]
            for t, ids in zip(part, self.model.encode(cut, num_threads=1), strict=True):
                self.known[t] = 1 if t == b" " else len(ids) - (t[:1] == b"\n")
        return np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))

    def count(self, texts: pa.Array) -> np.ndarray:
        """Pieces of each text; null and empty have none."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ")
        texts = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(" ", texts, ""))
        data, offsets = flat(texts)
        if not data.size:
            return np.zeros(len(offsets) - 1, np.int64)
        blank = data == 32
        first = blank | (data == 10)
        first[1:] &= ~(blank[1:] & blank[:-1])
        first[offsets[:-1][offsets[:-1] < data.size]] = True
        at = np.flatnonzero(first)
        codes, tokens = distinct(data, np.append(at, data.size))
        return sums(self.of(tokens)[codes], np.searchsorted(at, offsets))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 4096, remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether they are over the limit, one row per row of `docs`.

    Null texts count as empty, empty texts have no tokens, repeated rows and null ids stay as they
    are, other columns are not looked at, an empty table gives an empty one. The vocabulary file is
    read by the driver and sent along (below 1 MB), as executors need not have it.
    """
    with open(vocabulary, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        counter = PieceCounter(model.value, remembered)
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").cast(pa.string())
                n = counter.count(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
