"""Language identification by cross-parsing against a suffix automaton per language.

Labelled text of each language becomes a suffix automaton.  A text is parsed greedily into
the longest phrases that occur in a language's labelled text; the language that needs the
fewest phrases per character describes the text best.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts

#: Labelled characters per language that its automaton is built from (a bounded sample), and
#: of all languages together, which bounds the broadcast automata.
TRAIN_CHARS = 40_000
ALL_CHARS = 1_600_000
#: Labelled documents aimed at per language when drawing that sample.
TRAIN_DOCS = 64
#: Symbols: end of text, anything but a letter, a letter unseen in the labelled text, letters.
END, SPACE, OTHER, FIRST_LETTER = 0, 1, 2, 3
#: Texts are parsed in pieces of this many symbols, side by side, and read in blocks of about
#: as many characters as fit that grid.
PIECE = 2_048
PIECES_AT_ONCE = 1_024
#: Rows of symbols laid out at a time, and how often pieces are read again side by side.
CHUNK = 128
SIDE_BY_SIDE = 3
UNDETERMINED = "und"


LETTER = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)


def fold(text: str) -> np.ndarray:
    """Code points of the lower-cased text; runs of anything but letters become one 0."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(LETTER[points], points, np.uint32(0))
    gap = out == 0
    gap[1:] &= gap[:-1].copy()
    gap[:1] = False
    return out[~gap]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a string; state 0 is the root."""
    step: list[dict[int, int]] = [{}]
    link, longest = [-1], [0]
    last = 0
    for c in symbols:
        cur = len(step)
        step.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p != -1:
            q = step[p][c]
            if longest[p] + 1 == longest[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                longest.append(longest[p] + 1)
                while p != -1 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return step


@dataclass
class Table:
    """Next state, and whether a phrase ended before the symbol, by state * width + symbol."""
    next: np.ndarray
    ended: np.ndarray


def _grids(pieces: list[np.ndarray], block: Iterable[int], length: int) -> Iterator[np.ndarray]:
    """The pieces of ``block`` as columns, END below the shorter ones, CHUNK rows at a time."""
    for lo in range(0, length, CHUNK):
        grid = np.zeros((min(CHUNK, length - lo), len(block)), np.int32)
        for j, k in enumerate(block):
            part = pieces[k][lo:lo + CHUNK]
            grid[:len(part), j] = part
        yield grid


@dataclass
class LanguageModel:
    languages: list[str]
    #: symbol of each code point below the table's length; OTHER beyond it
    symbol_of: np.ndarray
    width: int
    #: per language
    tables: list[Table]

    def symbols(self, folded: np.ndarray) -> np.ndarray:
        if len(folded) and folded.max() >= len(self.symbol_of):
            inside = folded < len(self.symbol_of)
            return np.where(inside, self.symbol_of[np.where(inside, folded, 0)], OTHER)
        return self.symbol_of[folded]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases per text and language.

        Pieces of a text are parsed side by side, each as if a phrase began with it, and then again
        from where the piece before really ended, until both readings are in one state: from
        there on they agree.
        """
        owner, pieces = [], []
        for i, t in enumerate(texts):
            for a in range(0, len(t), PIECE):
                owner.append(i)
                pieces.append(t[a:a + PIECE])
        who = np.array(owner, np.int64)
        out = np.zeros((len(texts), len(self.tables)), np.int64)
        follows = np.append(False, who[1:] == who[:-1])
        order = np.array(sorted(range(len(pieces)), key=lambda k: len(pieces[k])), np.int64)
        for lang, table in enumerate(self.tables):
            ended, end = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
            for a in range(0, len(order), PIECES_AT_ONCE):
                block = order[a:a + PIECES_AT_ONCE]
                for grid in _grids(pieces, block, max(len(pieces[k]) for k in block)):
                    for row in grid:
                        at = end[block] * self.width + row
                        ended[block] += table.ended[at]
                        end[block] = table.next[at]
            self._joined(table, pieces, follows, ended, end)
            np.add.at(out[:, lang], who, ended)
            out[:, lang] += [len(t) > 0 for t in texts]  # the phrase that a text ends with
        return out

    def _joined(self, table: Table, pieces: list[np.ndarray], follows: np.ndarray, ended: np.ndarray,
                end: np.ndarray) -> None:
        """Sets ``ended`` and ``end`` of all pieces to what one reading of each whole text gives."""
        start = np.zeros(len(pieces), np.int64)
        before = np.roll(end, 1)
        for _ in range(SIDE_BY_SIDE):
            wrong = np.flatnonzero(follows & (before != start))
            if not len(wrong):
                return
            for a in range(0, len(wrong), PIECES_AT_ONCE):
                block = wrong[a:a + PIECES_AT_ONCE]
                old, new = start[block], before[block]
                start[block] = new
                for lo in range(0, PIECE, CHUNK):
                    for row in next(_grids([pieces[k][lo:lo + CHUNK] for k in block], range(len(block)), CHUNK)):
                        i, j = old * self.width + row, new * self.width + row
                        ended[block] += table.ended[j].astype(np.int64) - table.ended[i]
                        old, new = table.next[i].astype(np.int64), table.next[j].astype(np.int64)
                    apart = old != new
                    block, old, new = block[apart], old[apart], new[apart]
                    if not len(block):
                        break
                end[block] = new
            before = np.roll(end, 1)
        # what is left does not meet, as in endless repeats: one piece after the other
        seen: dict[tuple[bytes, int], tuple[int, int]] = {}
        for k in np.flatnonzero(follows):
            if end[k - 1] != start[k]:
                start[k] = end[k - 1]
                key = (pieces[k].tobytes(), int(start[k]))
                if key not in seen:
                    seen[key] = self._read(table, pieces[k].tolist(), int(start[k]))
                ended[k], end[k] = seen[key]

    def _read(self, table: Table, symbols: list[int], state: int) -> tuple[int, int]:
        count = 0
        for c in symbols:
            at = state * self.width + c
            count += int(table.ended[at])
            state = int(table.next[at])
        return count, state

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Language and margin of each text."""
        folded = [fold(t) for t in texts]
        known = np.array([bool(x.any()) for x in folded], bool)
        pred, score = np.full(len(folded), UNDETERMINED, object), np.zeros(len(folded))
        if not self.languages or not known.any():
            return pred, score
        n = self.phrases([self.symbols(x) for x, k in zip(folded, known) if k])
        pred[known] = np.array(self.languages, object)[n.argmin(axis=1)]
        if len(self.languages) == 1:
            score[known] = 1.0
        else:
            two = np.partition(n, 1, axis=1)
            score[known] = 1 - two[:, 0] / two[:, 1]
        return pred, score


def train(samples: dict[str, list[str]], chars: int = TRAIN_CHARS) -> LanguageModel:
    """Automata of at most ``chars`` folded characters per language, taken evenly from its texts."""
    folded: dict[str, np.ndarray] = {}
    chars = max(1, min(chars, ALL_CHARS // max(1, len(samples))))
    for lang in sorted(samples):
        texts = [x for x in (fold(t) for t in samples[lang]) if len(x)]
        share = max(1, chars // max(1, len(texts)))
        left = max(0, chars - sum(min(len(x), share) for x in texts))
        parts = []
        for x in texts:
            take = min(len(x), share + left)
            left -= max(0, take - share)
            parts += [x[:take], np.zeros(1, x.dtype)]
        if parts:
            folded[lang] = np.concatenate(parts)
    letters = sorted({int(p) for x in folded.values() for p in np.unique(x) if p})
    symbol_of = np.full(max(letters, default=0) + 1, OTHER, np.int32)
    symbol_of[0] = SPACE
    for i, p in enumerate(letters):
        symbol_of[p] = FIRST_LETTER + i
    width = FIRST_LETTER + len(letters)
    tables = []
    for lang in folded:
        step = suffix_automaton([int(symbol_of[p]) for p in folded[lang]])
        alone = len(step)  # an unseen symbol is a phrase of its own: nothing continues it
        stopped = alone + 1  # a text's end leads here, and nothing leads away
        root = np.full(width, alone, np.int32)
        for c, q in step[0].items():
            root[c] = q
        # where no transition fits, the phrase ends and the next one starts with this symbol
        kind = np.uint16 if stopped <= 0xFFFF else np.int32
        follow, ended = np.empty((stopped + 1, width), kind), np.ones((stopped + 1, width), bool)
        follow[:stopped] = root
        ended[0] = ended[stopped] = False
        for s, out in enumerate(step):
            for c, q in out.items():
                follow[s, c], ended[s, c] = q, False
        follow[:, END], ended[:, END] = stopped, False
        follow[stopped] = stopped
        tables.append(Table(follow.ravel(), ended.ravel()))
    return LanguageModel(list(folded), symbol_of, width, tables)


def labelled_sample(docs: DataFrame, train_rows: Column, text_col: str, label_col: str,
                    id_col: str, per_label: int, slice_chars: int) -> dict[str, list[str]]:
    """About ``per_label`` texts of each label, drawn by a hash of the id; of a long text
    the ``slice_chars`` characters from a place that another hash of the id draws.

    One narrow pass counts the rows per label, a second reads the texts whose hash falls
    under the label's rate; the driver gets a few times ``per_label`` texts per label at most.
    """
    rows = docs.filter(train_rows & F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(label_col).count().collect()}
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), F.lit(1_000_000))
    rate = F.lit(0)
    for label, n in counts.items():
        rate = F.when(F.col(label_col) == F.lit(label),
                      min(1_000_000, -(-1_000_000 * per_label // n))).otherwise(rate)
    places = F.greatest(F.lit(1), F.length(text_col) - slice_chars + 1)
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit(11)), places).cast("int") + 1
    chosen = (rows.filter(draw < rate)
              .select(F.col(label_col).alias("l"), F.col(id_col).alias("i"),
                      F.substring(F.col(text_col), place, F.lit(slice_chars)).alias("t")))
    out: dict[str, list[str]] = {}
    for r in sorted(chosen.collect(), key=lambda r: (str(r["i"]), r["t"])):
        out.setdefault(r["l"], []).append(r["t"])
    return out


def identify_language(docs: DataFrame, train_rows: Column, id_col: str = "doc_id",
                      text_col: str = "text", label_col: str = "lang",
                      train_chars: int = TRAIN_CHARS, train_docs: int = TRAIN_DOCS,
                      carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, the ``carry`` columns, lang_pred, score.

    ``train_rows`` selects the rows whose labels may be learnt from; the automata come from a
    bounded sample of them (about ``train_docs`` texts and at most ``train_chars`` characters per
    language, of each text twice its share from a drawn place), and every text is parsed whole.  The score is the margin between the best language and the
    next one, from 0 (tie) to 1.  Ties go to the language that sorts first.

    A NULL or letterless text, or a table without labels, gives ``und`` and 0.
    """
    model = train(labelled_sample(docs, train_rows, text_col, label_col, id_col, train_docs,
                                  max(1, 2 * train_chars // max(1, train_docs))), train_chars)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    return map_texts(docs, id_col, text_col, "lang_pred string, score double",
                     lambda texts: list(shared.value.judge(texts)), PIECE * PIECES_AT_ONCE, carry)
