"""Token counts by a deterministic transducer that is compiled from a BPE vocabulary.

The tokens of a BPE encoding are fixed by its neighbours: a sequence of pieces is the encoding of its text if
every two adjacent pieces are the encoding of their own concatenation. So, going left to right, one piece ends
at each position of the text, and the encoding of a prefix follows from what ended at the few earlier positions
where a longer piece may still begin. Those positions (the node of the vocabulary's trie, the piece that ended
there, and how many tokens fewer it had) are the state of the transducer; each transition is annotated with the
number of tokens by which it changes the count. States are compiled when first met and dropped when there are too
many, so memory is bounded.

A text is cut into chunks of equal length. A chunk maps the state before it to the state after it and a count. A
segment (white space marks and what follows) never merges with the one before it, so the map is constant beyond
the first segment border: it is kept as the text up to that border, the count of the closed segments, and the
text after the last border. Maps compose from left to right, in any grouping.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import sentencepiece
from pyspark.sql import DataFrame, functions as F

from paddock.llm.common import map_rows, text_or_empty

SPACE = "▁"
MAX_STATES = 200_000
MAX_PAIRS = 300_000
MAX_SEGMENTS = 200_000
SHIFT, MASK, HALF = 12, (1 << 12) - 1, 1 << 11  # a transition adds or takes fewer than HALF tokens
NOTHING: dict[str, int] = {}  # transitions of a state that has none yet
LONGEST_REMEMBERED = 48  # longer segments are run through the transducer each time


class Transducer:
    """Counts the tokens of a sentencepiece BPE model with byte fallback."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.score: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                self.score[model.id_to_piece(i)] = model.get_score(i)
        probe = " a  bﬁ　"
        if model.encode(probe) != model.encode(model.decode(model.encode(probe))):
            raise ValueError("the model rewrites its input; only models without normalization are supported")
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.score):
            raise ValueError("a piece spans words; only models that keep words apart are supported")
        inside = set("".join(p for p in self.score if len(p) > 1))
        inert = "".join(c for c in "\n\r\t" if c not in inside)  # characters that never merge
        self.segment = re.compile(f"[{inert}]|{SPACE}+[^{SPACE}{inert}]*|[^{SPACE}{inert}]+" if inert
                                  else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.border = re.compile(f"(?<=[^{SPACE}])(?={SPACE})" + (f"|(?<=[{inert}])(?=[^{SPACE}])" if inert else ""))
        self.children: list[dict[str, int]] = [{}]  # the vocabulary's trie, by node number
        self.ends: list[str | None] = [None]
        for piece in self.score:
            node = 0
            for c in piece:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                node = self.children[node][c]
            self.ends[node] = piece
        self.pairs: dict[tuple[str, str], bool] = {}
        self.segments: dict[str, int] = {}  # recently met segments, and those met before them
        self.older: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        # A state is a flat tuple of (node, piece that ended before it, tokens fewer then) for each open position.
        self.states: list[tuple] = [(0, None, 0)]
        self.numbers: dict[tuple, int] = {(0, None, 0): 0}
        self.moves: list[dict[str, int]] = [NOTHING]  # next state << SHIFT | tokens + HALF

    def cost(self, piece: str) -> int:
        """Tokens of one piece: a character outside the vocabulary is written as its bytes."""
        return 1 if piece in self.score else len(piece.encode("utf-8", "surrogatepass"))

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text by merging, best score first, leftmost first among equals."""
        parts = list(text)
        while len(parts) > 1:
            best = max(range(len(parts) - 1), key=lambda i: (self.score.get(parts[i] + parts[i + 1], -1e30), -i))
            if parts[best] + parts[best + 1] not in self.score:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def adjacent(self, left: str | None, piece: str) -> bool:
        """Whether `piece` may follow `left` in an encoding."""
        known = self.pairs.get((left, piece))
        if known is None:
            if len(self.pairs) > MAX_PAIRS:
                self.pairs.clear()
            wanted = [piece] if left is None else [left, piece]
            known = self.pairs[(left, piece)] = self.merged("".join(wanted)) == wanted
        return known

    def _compile(self, number: int, c: str) -> int:
        """The transition of a state on a character."""
        last, count, going = None, 0, []
        state = self.states[number]
        for k in range(0, len(state), 3):
            node, left, less = state[k:k + 3]
            child = self.children[node].get(c)
            piece = None if child is None else self.ends[child]
            if node == 0 and piece is None:
                piece = c  # any character is a symbol of its own
            if piece is not None and last is None and self.adjacent(left, piece):
                last, count = piece, less + self.cost(piece)
            if child is not None and self.children[child]:  # a longer piece may go on here
                going.append((child, left, less))
        state = (*(x for node, left, less in going for x in (node, left, less - count)), 0, last, 0)
        found = self.numbers.get(state)
        if found is None:
            found = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append(NOTHING)
        if self.moves[number] is NOTHING:
            self.moves[number] = {}
        move = self.moves[number][c] = found << SHIFT | count + HALF
        return move

    def run(self, text: str, number: int = 0) -> tuple[int, int]:
        """State and count after reading `text` from a state."""
        total, moves = 0, self.moves
        for c in text:
            try:
                move = moves[number][c]
            except KeyError:
                move = self._compile(number, c)
            number = move >> SHIFT
            total += move & MASK
        return number, total - len(text) * HALF

    def count(self, segment: str) -> int:
        """Tokens of one whole segment, read from the initial state."""
        found = self.segments.get(segment)
        if found is None:
            found = self.older.get(segment)
            if found is None:
                if len(self.states) > MAX_STATES:
                    self._forget()
                found = self.run(segment)[1]
            if len(segment) <= LONGEST_REMEMBERED:
                if len(self.segments) >= MAX_SEGMENTS:
                    self.older, self.segments = self.segments, {}
                self.segments[segment] = found
        return found

    def whole(self, text: str) -> int:
        """Tokens of a text that begins at a segment border."""
        return sum(map(self.count, self.segment.findall(text)))

    def chunk_map(self, chunk: str) -> tuple[str, int | None, str]:
        """What a chunk does to any state: head, tokens between its first and last border (None: no border), tail."""
        borders = [m.start() for m in self.border.finditer(chunk)]
        if not borders:
            return chunk, None, ""
        return chunk[:borders[0]], self.whole(chunk[borders[0]:borders[-1]]), chunk[borders[-1]:]

    def composed(self, maps: list) -> int:
        """Tokens of a text from the maps of its chunks, in order."""
        state, total = 0, 0
        for head, closed, tail in maps:
            if len(self.states) > MAX_STATES and state == 0:
                self._forget()
            state, n = self.run(head, state)
            total += n
            if closed is not None:
                state, n = self.run(tail)
                total += closed + n
        return total


@lru_cache(maxsize=2)
def transducer(model_file: str) -> Transducer:
    return Transducer(model_file)


def token_counts(
    docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text",
    chunk_chars: int = 1 << 16, limit: int = 4096,
) -> DataFrame:
    """Tokens of every whole text, as the model's own library counts them without begin and end tokens.

    One row per input row, repeated rows included: the id, n_bytes (UTF-8), n_tokens, over_limit (more than
    `limit` tokens), n_chunks. A null text counts as empty and has no tokens; a null id stays null; other columns
    are not read. Texts longer than `chunk_chars` are counted chunk by chunk and their chunk maps composed.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").alias("id"),
        text_or_empty(text_column).alias("text"),
    ).withColumn("n_bytes", F.octet_length("text").cast("long"))
    id_type = rows.schema["id"].dataType.simpleString()

    def maps(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        counter = transducer(model_file)
        for batch in batches:
            out = []
            for row, key, text, size in zip(batch["row"], batch["id"], batch["text"], batch["n_bytes"]):
                text = SPACE + text.replace(" ", SPACE) if text else ""
                if len(text) <= chunk_chars:
                    out.append((row, key, size, 0, "", counter.whole(text), ""))
                    continue
                for number, at in enumerate(range(0, len(text), chunk_chars)):
                    out.append((row, key, size, number, *counter.chunk_map(text[at:at + chunk_chars])))
            yield out

    def composed(batches: Iterator[dict[str, list]]) -> Iterator[list[tuple]]:
        counter = transducer(model_file)
        for batch in batches:
            yield [
                (key, size, len(found), counter.composed([(x["head"], x["closed"], x["tail"]) for x in found]))
                for key, size, found in zip(batch["id"], batch["n_bytes"], batch["maps"])
            ]

    chunks = map_rows(
        rows, maps, f"row long, id {id_type}, n_bytes long, number long, head string, closed long, tail string")
    texts = chunks.groupBy("row", "id", "n_bytes").agg(
        F.array_sort(F.collect_list(F.struct("number", "head", "closed", "tail"))).alias("maps"))
    counted = map_rows(
        texts.select("id", "n_bytes", "maps"), composed, f"id {id_type}, n_bytes long, n_chunks long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_chunks")
