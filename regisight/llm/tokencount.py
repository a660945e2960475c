"""Token counts of a piece vocabulary by a compiled deterministic transducer.

A sequence of pieces is the vocabulary's encoding of a text exactly if each two neighbours are: the last
piece of a prefix's encoding is the one suffix whose encoding, after the piece before it, stays itself. So
reading one character leads from a state (the characters since the last word start, as far back as a piece
can reach, with the last piece and the relative count at each of them) to one next state, and the transition
carries how many tokens the count changes by. Transitions are compiled when first used and kept while the
table has room; the sum along a text is its number of tokens. A space after a non-space begins a new word, no
piece crosses it, and the state is reset.

Long texts are cut into chunks. A chunk's state map is (head, rest): the head are the characters before its
first reset, which depend on the state before, the rest's state and count don't. Two maps compose to a map
of the same form, and a prefix scan in log2(chunks) rounds gives the map of every prefix.

Defined results: a null or empty text has no tokens; characters that are no pieces count their UTF-8 bytes
(byte fallback); repeated rows are counted each by itself; an empty table gives an empty table; other columns
are ignored. Everything is per row, nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regisight.llm.common import texts

LIMIT = 4096
CHUNK = 1 << 16
STATES, WORDS, PAIRS = 20_000, 1_000_000, 1_000_000
NEVER = float("inf")
RUNS = regex.compile(" +[^ ]*").findall
RESET = regex.compile("(?<=[^ ]) ").search

#: What one state holds: the characters read, and per position (oldest first) the last piece and the count.
State = tuple[str, tuple[tuple[str, int], ...]]
START: State = ("", (("", 0),))


class Transducer:
    """Counts of one vocabulary file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [(i, model.IdToPiece(i).replace("▁", " ")) for i in range(model.vocab_size())
                  if not (model.IsControl(i) or model.IsUnknown(i) or model.IsByte(i) or model.IsUnused(i))]
        self.rank = {p: -model.GetScore(i) for i, p in pieces}
        self.reach = max(len(p) for p in self.rank)
        self.longest: dict[str, int] = {}  # of the pieces that end in these (up to) two characters
        for piece in self.rank:
            self.longest[piece[-2:]] = max(self.longest.get(piece[-2:], 1), len(piece))
        self.stands: dict[tuple[str, str], bool] = {}
        self.table: dict[State, dict[str, tuple[State, int]]] = {}
        self.words = _Words(self)

    def merged(self, text: str) -> list[str]:
        """Merging by best rank, leftmost first; only for texts of one or two pieces."""
        parts, rank = list(text), self.rank.get
        ranks = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) != NEVER:
            k = ranks.index(low)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank(parts[k - 1] + parts[k], NEVER)
            if k < len(ranks):
                ranks[k] = rank(parts[k] + parts[k + 1], NEVER)
        return parts

    def fits(self, before: str, piece: str) -> bool:
        """Whether the encoding of `before` and `piece` in a row is just these two."""
        key = (before, piece)
        got = self.stands.get(key)
        if got is None:
            got = self.merged(before + piece) == ([before, piece] if before else [piece])
            if len(self.stands) >= PAIRS:
                self.stands.clear()
            self.stands[key] = got
        return got

    def read(self, state: State, text: str, final: bool = True) -> tuple[State | None, int]:
        """(state after text, change of the count) without the table; final: whether the state is asked for."""
        chars, total = state[0], 0
        last, count = [p for p, _ in state[1]], [n for _, n in state[1]]
        rank, longest, stands = self.rank, self.longest, self.stands
        for c in text:
            if c == " " and chars and chars[-1] != " ":
                total += count[-1]
                chars, last, count = "", [""], [0]
            chars += c
            for length in range(min(longest.get(chars[-2:], 1), len(chars), len(last)), 0, -1):
                piece = chars[-length:]
                if length == 1 or piece in rank:
                    before = last[-length]
                    ok = stands.get((before, piece))
                    if self.fits(before, piece) if ok is None else ok:
                        last.append(piece)
                        count.append(count[-length] + (1 if piece in rank else len(piece.encode("utf-8", "surrogatepass"))))
                        break
        end = count[-1]
        if not final:
            return None, total + end
        keep = self.reach
        return (chars[-keep:], tuple((p, n - end) for p, n in zip(last[-keep:], count[-keep:], strict=True))), total + end

    def run(self, state: State, text: str, final: bool = True) -> tuple[State | None, int]:
        total, table = 0, self.table
        for k, c in enumerate(text):
            moves = table.get(state)
            to = None if moves is None else moves.get(c)
            if to is None:
                if len(table) >= STATES:
                    state, change = self.read(state, text[k:], final)
                    return state, total + change
                to = self.read(state, c)
                table.setdefault(state, {})[c] = to
            state, change = to
            total += change
        return state, total

    def chunk_map(self, chunk: str) -> tuple[str, State | None, int]:
        """(head, state after the rest or None without a reset, count of the rest)."""
        reset = RESET(chunk)
        if reset is None:
            return chunk, None, 0
        head, rest = chunk[: reset.start()], chunk[reset.start() :]
        words = self.split(rest)
        state, count = self.run(START, words[-1])
        return head, state, count + sum(map(self.words.__getitem__, words[:-1]))

    def compose(self, a: tuple[str, State | None, int], b: tuple[str, State | None, int]) -> tuple[str, State | None, int]:
        if a[1] is None:
            return a[0] + b[0], b[1], b[2]
        state, count = self.run(a[1], b[0])
        return a[0], state if b[1] is None else b[1], a[2] + count + b[2]

    def split(self, text: str) -> list[str]:
        """Words of a text that begins with a space, each with the spaces before it."""
        if "  " in text or text.endswith(" "):
            return RUNS(text)
        return [" " + w for w in text.split(" ")[1:]]

    def count(self, text: str) -> int:
        """Number of tokens of a whole text."""
        if not text:
            return 0
        form = " " + text.replace("▁", " ")
        if len(form) <= CHUNK:
            return sum(map(self.words.__getitem__, self.split(form)))
        maps = [self.chunk_map(form[i : i + CHUNK]) for i in range(0, len(form), CHUNK)]
        apart = 1
        while apart < len(maps):  # parallel prefix scan: after the last round maps[k] is that of chunks 0..k
            maps = maps[:apart] + [self.compose(maps[k - apart], maps[k]) for k in range(apart, len(maps))]
            apart *= 2
        head, _, rest = maps[-1]
        return self.run(START, head)[1] + rest


class _Words(dict):
    """Composite transitions: the count of a whole word from the reset state, for words of usual length."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, word: str) -> int:
        count = self.transducer.run(START, word, False)[1]
        if len(word) <= 64:
            if len(self) >= WORDS:
                self.clear()
            self[word] = count
        return count


_TRANSDUCERS: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _TRANSDUCERS:
        _TRANSDUCERS[path] = Transducer(path)
    return _TRANSDUCERS[path]


def count_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(vocabulary)
        for b in batches:
            batch = list(texts(b.column(1)))
            n = [t.count(x) for x in batch]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x.encode()) for x in batch], pa.int64()), pa.array(n, pa.int64()), pa.array([k > limit for k in n], pa.bool_())],
                                             names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
