"""Token counts under a unigram vocabulary, by dynamic programming over a trie of pre-tokens.

A pre-token is a word with a leading word mark. Its count is the number of pieces in the best
segmentation (largest sum of log probabilities; fewer pieces on a tie); a character that no piece
covers counts one token per byte. The distinct pre-tokens of a batch are put in a trie, in the
order of a depth-first walk: neighbours share their longest common prefix, and the forward scores
of a shared prefix are worked out once. A terminal node stores its pre-token's count, and a
document's count is the sum over its pre-tokens.

The trie is built per batch of documents inside the task. A trie over the whole corpus would have
to shuffle every (document, pre-token) pair to meet the counts again, which is several times the
text. Counts of earlier batches are remembered up to ``REMEMBERED`` pre-tokens per task, so memory
is bounded. The vocabulary is a file of fixed size named by a parameter and read on the driver.

The probabilities are Zipf's law over the vocabulary's own order, as its files give ranks only.

Nulls, empties and ties: a null text counts as empty and has no token; repeated rows are counted
each; a pre-token of any length is walked in one pass.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from starloom.llm.common import whole

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
REMEMBERED = 200_000
BYTE_SCORE = -40.0  # log probability of a byte that stands in for an unknown character


def vocabulary(path: str = VOCABULARY) -> dict[str, float]:
    """Log probability per piece of a sentencepiece model, by Zipf's law on its order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = math.log(sum(1 / (r + 1) for r in range(len(ids))))
    return {model.id_to_piece(i): -math.log(r + 1) - total for r, i in enumerate(ids)}


def piece_trie(pieces: dict[str, float]) -> dict:
    """Nested dictionaries by character; the empty key holds a piece's score."""
    root: dict = {}
    for piece, score in pieces.items():
        node = root
        for c in piece:
            node = node.setdefault(c, {})
        node[""] = score
    return root


def trie_counts(tokens: list[str], root: dict) -> dict[str, int]:
    """Tokens per pre-token, for distinct pre-tokens.

    Walks the trie of the pre-tokens depth first. The state after ``i`` characters is the best score
    and count of that prefix and the places from which a piece is still being spelled.
    """
    counts: dict[str, int] = {}
    scores, sizes, alive = [0.0], [0], [[(0, root)]]
    before = ""
    for token in sorted(tokens):
        shared = 0
        for a, b in zip(before, token):
            if a != b:
                break
            shared += 1
        del scores[shared + 1:], sizes[shared + 1:], alive[shared + 1:]
        for i in range(shared, len(token)):
            c, open_here = token[i], []
            width = len(c.encode("utf-8", "surrogatepass"))
            best, size = scores[i] + BYTE_SCORE * width, sizes[i] + width
            for start, node in alive[i]:
                child = node.get(c)
                if child is None:
                    continue
                open_here.append((start, child))
                own = child.get("")
                if own is not None:
                    score = scores[start] + own
                    if score > best or score == best and sizes[start] + 1 < size:
                        best, size = score, sizes[start] + 1
            open_here.append((i + 1, root))
            scores.append(best)
            sizes.append(size)
            alive.append(open_here)
        counts[token] = sizes[len(token)]
        before = token
    return counts


def count_tokens(docs: DataFrame, text: str = "text", path: str = VOCABULARY, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of each row plus ``n_pretokens``, ``n_tokens`` and ``n_distinct`` pre-tokens."""
    pieces = docs.sparkSession.sparkContext.broadcast(vocabulary(path))  # as large as the vocabulary file

    @F.pandas_udf("n_pretokens long, n_tokens long, n_distinct long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        root, known = piece_trie(pieces.value), {}
        for batch in batches:
            out = []
            for begin in range(0, len(batch), 256):
                per_doc = [Counter(t.split()) for t in batch.iloc[begin:begin + 256]]
                fresh = {MARK + w for c in per_doc for w in c if w not in known}
                if len(known) > REMEMBERED:
                    known.clear()
                    fresh = {MARK + w for c in per_doc for w in c}
                known.update((t[1:], n) for t, n in trie_counts(list(fresh), root).items())
                out += [(sum(c.values()), sum(known[w] * n for w, n in c.items()), len(c)) for c in per_doc]
            yield pd.DataFrame(out, columns=["n_pretokens", "n_tokens", "n_distinct"])

    return docs.select(*keep, count(whole(text)).alias("_c")).select(*keep, "_c.*")
