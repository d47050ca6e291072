"""Token counts of texts by a tokenizer compiled to a deterministic transducer.

A sentencepiece model of kind BPE joins, as long as it can, the neighbouring pair whose joined piece has the best score.
A cut of a text into pieces is the model's if and only if each piece alone and each two neighbours alone are cut
that way: as long as no join crosses a bound, what happens on its two sides are the joins of the sides alone, in
the same order. So among the pieces that end at a place, exactly one goes with the last piece before
it, and reading on needs only this of the text so far: for each of its ends that a longer piece may begin with, the last piece
before that end and how many tokens the text gained since. These are the states, finitely many. Reading a character leads to one
next state, and each transition is annotated with the tokens it emits, which are less than 0 where a character joins earlier ones.
Transitions are compiled when they are first taken; a text's tokens are the sum of what it emits. Two characters that stand
side by side in no piece are always parted, so the second starts anew: there the state doesn't depend on what came before.

Texts are cut into chunks at fixed places, wherever these fall. A chunk's state map says what it does from any state: up to the first
place where reading starts anew it waits for the state, from there on count and last state are known. Maps compose
associatively, and a text's maps are combined as the tree of a parallel prefix scan does, neighbours first. Inside a
chunk, words between blanks that start anew are transitions of their own, remembered with the tokens they emit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Code points in a chunk.
CHUNK = 1 << 14
#: Compiled states and remembered words in one worker; beyond, compiling starts anew.
MAX_STATES, MAX_WORDS = 200_000, 300_000
LIMIT = 4096
#: How the model writes a blank.
BLANK = "▁"
#: Texts on which a model that rewrites characters or drops blanks shows itself.
_PROBES = ("a  b ", " ﬁ①　  x\t", "ÅÅ\n\n")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_model(path: str) -> dict[str, float]:
    """Scores of the pieces that a text can be joined to, for a BPE model with byte fallback that keeps texts as they are."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    if any(model.is_unused(i) for i in ids):
        raise ValueError("pieces marked unused are not supported")
    if sum(model.is_byte(i) for i in ids) != 256:
        raise ValueError("a model with byte fallback is needed")
    for probe in _PROBES:
        if model.normalize(probe) != (BLANK + probe).replace(" ", BLANK):
            raise ValueError("the model rewrites texts")
    return {model.id_to_piece(i): model.get_score(i) for i in ids if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))}


class State(dict):
    """Transitions (next state, tokens emitted) by character, compiled when first taken.

    `live` has (characters, last piece before them, tokens gained with them) for each end of the text that a piece may go on from,
    the longest first; `tail` is the longest of them, `last` the last character. No piece before means: the text starts there.
    """

    __slots__ = ("last", "live", "machine", "tail")

    def __init__(self, machine: Transducer, live: tuple, tail: str, last: str):
        super().__init__()
        self.machine, self.live, self.tail, self.last = machine, live, tail, last

    def __missing__(self, char: str) -> tuple[State, int]:
        made = self[char] = self.machine.transition(self, char)
        return made


class Transducer:
    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.prefixes = {p[:j] for p in scores for j in range(1, len(p))}
        self.pairs = {p[j:j + 2] for p in scores for j in range(len(p) - 1)}
        self.parts_at_blank = not any(pair[1] == BLANK != pair[0] for pair in self.pairs)
        self._clear()

    def _clear(self) -> None:
        self.states: dict[tuple, State] = {}
        self.joins: dict[tuple[str, str], bool] = {}
        self.words: dict[str, int] = {}
        self.start = State(self, ((0, None, 0),), "", "")

    def pieces(self, text: str) -> list[str]:
        """The text joined by score, the first of equal pairs first. Used on two pieces at a time."""
        parts, scores = list(text), self.scores
        while True:
            best = at = None
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, before: str, piece: str) -> bool:
        """Whether the two stay two pieces, each being one by itself."""
        key = (before, piece)
        if key not in self.joins:
            self.joins[key] = self.pieces(before + piece) == [before, piece]
        return self.joins[key]

    def restarts(self, before: str, char: str) -> bool:
        """Whether no piece holds the two characters side by side."""
        return before + char not in self.pairs

    def transition(self, state: State, char: str) -> tuple[State, int]:
        if state is not self.start and self.restarts(state.last, char):
            return self.start[char]
        tail = state.tail
        ends = [(n, before, gained, tail[len(tail) - n:] + char) for n, before, gained in state.live]
        for n, before, gained, piece in ends:
            # one always goes; the last, the character alone, needs no test
            if n and (piece not in self.scores or not (self.follows(before, piece) if before is not None else self.pieces(piece) == [piece])):
                continue
            break
        emitted = (1 if piece in self.scores else len(piece.encode())) - gained
        live = [(n + 1, before, gained + emitted) for n, before, gained, end in ends if end in self.prefixes]
        key = ((*live, (0, piece, 0)), (tail + char)[len(tail) + 1 - live[0][0]:] if live else "", char)
        found = self.states.get(key)
        if found is None:
            if len(self.states) >= MAX_STATES:
                self.states.clear()  # states in use stay alive by themselves, the start forgets where it led
                self.joins.clear()
                self.start.clear()
            found = self.states[key] = State(self, *key)
        return found, emitted

    def read(self, state: State, text: str) -> tuple[State, int]:
        tokens = 0
        for char in text:
            state, emitted = state[char]
            tokens += emitted
        return state, tokens

    def word(self, text: str) -> int:
        """Tokens of a text from the start."""
        tokens = self.words.get(text)
        if tokens is None:
            if len(self.words) >= MAX_WORDS:
                self.words.clear()
            tokens = self.words[text] = self.read(self.start, text)[1]
        return tokens

    def map_of(self, chunk: str) -> Map:
        """What a chunk does from any state."""
        first = next((i for i in range(1, len(chunk)) if self.restarts(chunk[i - 1], chunk[i])), None)
        if first is None:
            return Map(self, chunk, chunk[-1:], 0, None)
        known = chunk[first:]
        if not self.parts_at_blank:
            state, tokens = self.read(self.start, known)
            return Map(self, chunk[:first], known[-1], tokens, state)
        words = _WORD.findall(known)
        state, tokens = self.read(self.start, words.pop())
        return Map(self, chunk[:first], known[-1], tokens + sum(map(self.word, words)), state)

    def count(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a text."""
        if not text:
            return 0
        written = BLANK + text.replace(" ", BLANK)
        maps = [self.map_of(written[i:i + chunk]) for i in range(0, len(written), chunk)]
        return composed(maps).apply(self.start)[1]


#: A word with the blanks before it: it starts anew where one that isn't a blank precedes.
_WORD = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")


@dataclass(frozen=True)
class Map:
    """A chunk's effect on a state: read `entry`, then emit `tokens` and go to `state`.

    Without a state the chunk is `entry` alone: nowhere in it reading starts anew. `last` is its last character.
    """

    machine: Transducer
    entry: str
    last: str
    tokens: int
    state: State | None

    def apply(self, state: State) -> tuple[State, int]:
        reached, tokens = self.machine.read(state, self.entry)
        return reached if self.state is None else self.state, tokens + self.tokens  # a state not yet left is an empty dict

    def then(self, after: Map) -> Map:
        """This map and the one after it as one. Associative."""
        if self.state is None:
            if not self.entry or not after.entry or not self.machine.restarts(self.last, after.entry[0]):
                return Map(self.machine, self.entry + after.entry, after.last or self.last, after.tokens, after.state)
            state, tokens = after.apply(self.machine.start)
            return Map(self.machine, self.entry, after.last, tokens, state)
        state, tokens = after.apply(self.state)
        return Map(self.machine, self.entry, after.last or self.last, self.tokens + tokens, state)


def composed(maps: list[Map]) -> Map:
    """All maps as one: neighbours are composed, then neighbours of these, in as many rounds as the logarithm of their number."""
    while len(maps) > 1:
        pairs = [a.then(b) for a, b in zip(maps[::2], maps[1::2], strict=False)]
        maps = pairs + maps[len(pairs) * 2:]
    return maps[0]


def count(docs: DataFrame, model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row (doc_id, text).

    `n_tokens` is what the model at that path makes of the whole text, without begin, end or other special tokens; strings
    that look like special tokens are ordinary text. Null and empty texts have none. Rows are independent: ids may be null
    or repeated, and other columns are ignored. Nothing is shuffled; a worker's compiled states and words are bounded.
    """
    path = model or default_model()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer(read_model(path))
        for batch in batches:
            tokens = pa.array([machine.count(text.as_py()) for text in batch["text"]], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_bytes"], tokens], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    found = rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
