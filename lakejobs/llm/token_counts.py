"""Token counts by greedy longest match, without building the pieces.

The vocabulary is a trie. A failure link leads from a node, once its longest token is
popped, to the node of what remains; the number of tokens popped on the way is stored
beside it. A word of n bytes is then counted in O(n), whatever its pieces are.
"""

from __future__ import annotations

import base64
import gzip
from collections import deque
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame

from lakejobs.llm.common import map_texts

# Counts of distinct words a worker remembers before it starts afresh; result-neutral.
MEMO_WORDS = 300_000
UNKNOWN = -1


class Automaton:
    """Counts greedy longest-match pieces of a word.

    ``initial`` are pieces that may start a word and ``inner`` those that may continue
    one. A word that the vocabulary cannot spell counts as one unknown token.
    """

    def __init__(self, initial: Iterable[bytes], inner: Iterable[bytes]):
        # Nodes 0 and 1 are the roots for the start and for the rest of a word.
        goto: dict[int, int] = {}
        parent, label, final = [0, 0], [0, 0], [False, False]
        children: list[list[int]] = [[], []]
        for root, pieces in ((0, initial), (1, inner)):
            for piece in pieces:
                node = root
                for byte in piece:
                    key = node << 8 | byte
                    if key not in goto:
                        goto[key] = len(parent)
                        children[node].append(len(parent))
                        parent.append(node)
                        label.append(byte)
                        final.append(False)
                        children.append([])
                    node = goto[key]
                final[node] = node != root
        fail, popped = [-1] * len(parent), [0] * len(parent)
        queue = deque(children[0] + children[1])
        while queue:
            node = queue.popleft()
            queue.extend(children[node])
            if final[node]:
                fail[node], popped[node] = 1, 1
                continue
            above, count = fail[parent[node]], popped[parent[node]]
            while above >= 0 and (above << 8 | label[node]) not in goto:
                count += popped[above]
                above = fail[above]
            if above >= 0:
                fail[node], popped[node] = goto[above << 8 | label[node]], count
        self.goto, self.fail, self.popped = goto, fail, popped

    def count(self, word: bytes) -> int:
        """Pieces in ``word``; UNKNOWN if it has no spelling."""
        goto, fail, popped = self.goto, self.fail, self.popped
        node = count = 0
        for byte in word:
            step = goto.get(node << 8 | byte)
            while step is None:
                count += popped[node]
                node = fail[node]
                if node < 0:
                    return UNKNOWN
                step = goto.get(node << 8 | byte)
            node = step
        while node != 1:
            if node < 0:
                return UNKNOWN
            count += popped[node]
            node = fail[node]
        return count


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a vocabulary file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


@lru_cache(maxsize=2)
def _automaton(packed: bytes) -> tuple[Automaton, dict[str, int]]:
    tokens = [base64.b64decode(x) for x in gzip.decompress(packed).split(b"\n")]
    spaced = [t for t in tokens if t.startswith(b" ")]
    return Automaton(spaced, [t for t in tokens if not t.startswith(b" ")]), {}


def count_text(text: str | None, automaton: Automaton, memo: dict[str, int]) -> tuple[int, int]:
    """Words and tokens of a text; (0, 0) for None."""
    if not text:
        return 0, 0
    words = text.split()
    total = 0
    for word in words:
        n = memo.get(word)
        if n is None:
            n = automaton.count(b" " + word.encode("utf-8", "surrogatepass"))
            n = 1 if n == UNKNOWN else n
            if len(word) <= 64:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                memo[word] = n
        total += n
    return len(words), total


def token_counts(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, n_words and n_tokens per row, over the whole text.

    ``vocabulary`` names a file of byte tokens on the driver, where a leading blank marks
    a token that starts a word; it goes to the workers with the job (a few hundred
    kilobytes). Words are what white space separates, and white space itself has no
    token. NULL and empty texts count 0 words and 0 tokens; repeated rows are counted
    each on its own; other columns are not read.
    """
    packed = gzip.compress(b"\n".join(base64.b64encode(t) for t in read_ranks(vocabulary)))

    def run(texts: list) -> dict:
        automaton, memo = _automaton(packed)
        counts = [count_text(t, automaton, memo) for t in texts]
        return {"n_words": [c[0] for c in counts], "n_tokens": [c[1] for c in counts]}

    return map_texts(docs, [id_col], text_col, "n_words long, n_tokens long", run)
