"""Language identification by cross-parsing: a text is cut into the longest phrases that occur in a language's
sample; the language that needs the fewest phrases for the text's length wins."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The bounded training sample: so many characters per language, dealt out evenly to so many texts at most.
SAMPLE_CHARS = 12_000
SAMPLE_TEXTS = 200
RANK_PARTS = 64
# Long texts are parsed in windows of this many letters and spaces, which lets a batch be parsed side by side.
WINDOW = 1024


def fold(text: str) -> str:
    """Lower-case letters, with one space for each run of anything else."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


# Codes below this, those of the most frequent characters, have a column of the transition table each; the few transitions by
# other characters are kept as a sorted list, so that a large alphabet does not make a large table.
DENSE = 64
# Texts of so many letters at least are judged on whether they are in a learned language at all, by the phrase rates of all
# labelled texts, which are counted in so many steps from 0 to 1.
LEAST_LETTERS, RATE_STEPS = 200, 1 << 13
FOREIGN, OWN = 0.8, 0.95


def suffix_automaton(codes: np.ndarray) -> list[dict[int, int]]:
    """Transitions code -> state by state of the automaton of all substrings; 0 is the start."""
    links, lengths, moves = [-1], [0], [{}]
    last = 0
    for c in codes.tolist():
        now = len(lengths)
        lengths.append(lengths[last] + 1)
        links.append(0)
        moves.append({})
        at = last
        while at != -1 and c not in moves[at]:
            moves[at][c] = now
            at = links[at]
        if at != -1:
            to = moves[at][c]
            if lengths[at] + 1 == lengths[to]:
                links[now] = to
            else:
                copy = len(lengths)
                lengths.append(lengths[at] + 1)
                links.append(links[to])
                moves.append(dict(moves[to]))
                while at != -1 and moves[at].get(c) == to:
                    moves[at][c] = copy
                    at = links[at]
                links[to] = links[now] = copy
        last = now
    return moves


@dataclass
class LanguageModel:
    """langs: the learned values. codes: character -> code, by falling frequency; unknown letters have the code ``alphabet -
    1``, which no automaton holds. table: the automata of all languages one below the other, row ``starts[k]`` being the
    start of language k, for codes below ``DENSE - 1``; a missing transition leads to -1. keys, targets: the
    transitions by other codes, ``state * alphabet + code`` in order. cuts: by language the phrase rate above which a text is
    taken for one of no learned language."""

    langs: list[str]
    codes: dict[str, int]
    table: np.ndarray
    keys: np.ndarray
    targets: np.ndarray
    starts: np.ndarray
    cuts: np.ndarray | None = None

    @property
    def alphabet(self) -> int:
        return len(self.codes) + 1

    def move(self, state: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The state that each of (language, window) states goes to by its window's character, -1 for none."""
        to = self.table.reshape(-1)[state * DENSE + np.minimum(chars, DENSE - 1)]
        rare = np.flatnonzero(chars >= DENSE - 1)
        if len(rare) and len(self.keys):
            wanted = state[:, rare].astype(np.int64) * self.alphabet + chars[rare]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            to[:, rare] = np.where(self.keys[at] == wanted, self.targets[at], -1)
        return to


def build(samples: dict[str, str]) -> LanguageModel:
    """The automata of a text per language."""
    counts: dict[str, int] = {" ": 0}
    for sample in samples.values():
        for c in sample:
            counts[c] = counts.get(c, 0) + 1
    codes = {c: i for i, c in enumerate(sorted(counts, key=lambda c: (-counts[c], c)))}
    alphabet = len(codes) + 1
    tables, starts, edges, at = [], [], [], 0
    for sample in samples.values():
        moves = suffix_automaton(np.array([codes[c] for c in sample], np.int64))
        table = np.full((len(moves), DENSE), -1, np.int32)
        for state, out in enumerate(moves):
            for c, to in out.items():
                if c < DENSE - 1:
                    table[state, c] = to + at
                else:
                    edges.append(((state + at) * alphabet + c, to + at))
        tables.append(table)
        starts.append(at)
        at += len(moves)
    listed = np.array(sorted(edges), np.int64).reshape(-1, 2)
    table = np.concatenate(tables) if tables else np.zeros((0, DENSE), np.int32)
    return LanguageModel(list(samples), codes, table, listed[:, 0].copy(), listed[:, 1].astype(np.int32), np.array(starts, np.int32))


def _sample(parts: list[tuple[int, str]], chars: int) -> str:
    """A stretch of each of the (hash, text), of one length for all that are long enough, joined in hash order."""
    sizes = sorted(len(p) for _, p in parts)
    room, width, more = chars - len(parts) + 1, sizes[-1], 0
    for k, size in enumerate(sizes):
        if size * (len(sizes) - k) > room:
            width, more = divmod(max(0, room), len(sizes) - k)
            break
        room -= size
    out = []
    for at, part in parts:
        size = width + (more > 0 and len(part) > width)
        more -= size > width
        start = at % max(1, len(part) - size + 1)
        out.append(part[start : start + size])
    return " ".join(out)[:chars]


def train(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", sample_chars: int = SAMPLE_CHARS, sample_texts: int = SAMPLE_TEXTS) -> LanguageModel:
    """Automata of a bounded sample per language; rows without text or language are left out.

    The sample is a passage of each of the ``sample_texts`` distinct texts with the smallest hashes, however often a
    text is repeated, and follows neither the order of rows nor that of texts. Passages lie at hashed positions of the
    whole texts and are of equal length, about ``sample_chars / sample_texts`` characters; where a language has fewer
    or shorter texts, the others' are longer, until ``sample_chars`` are reached. The hashes are picked first, so that no
    more than the sample, at four times its size, is sent to the driver."""
    rows = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("at"))
    # In two steps, so that the texts of a frequent language are not ranked by one task.
    part, whole = (F.row_number().over(Window.partitionBy("lang", *by).orderBy("at")) for by in ([F.pmod("at", F.lit(RANK_PARTS))], []))
    hashes = rows.select("lang", "at").distinct().withColumn("rank", part).filter(F.col("rank") <= sample_texts)
    hashes = hashes.withColumn("rank", whole).filter(F.col("rank") <= sample_texts)
    last = hashes.groupBy("lang").agg(F.max("at").alias("last"), F.count("*").alias("texts"))  # a row per language
    size = (F.lit(4 * sample_chars) / F.col("texts")).cast("int")
    start = F.pmod(F.col("at"), F.greatest(F.length("text") - size + 1, F.lit(1)).cast("bigint")).cast("int") + 1
    near = rows.join(F.broadcast(last), "lang").filter(F.col("at") <= F.col("last"))
    picked = near.groupBy("lang", "at").agg(F.min(F.col("text").substr(start, size)).alias("part")).collect()
    texts: dict[str, list[tuple[int, str]]] = {}
    for row in sorted(picked):
        if part := fold(row.part):
            texts.setdefault(row.lang, []).append((row.at, part))
    samples = {lang: _sample(parts, sample_chars) for lang, parts in sorted(texts.items())}
    return build(samples)


def _quantile(steps: dict[int, int], share: float) -> float:
    """The rate below which ``share`` of the texts lie, from their numbers by step."""
    order = sorted(steps)
    upto = np.cumsum([steps[step] for step in order])
    return (order[int(np.searchsorted(upto, share * (upto[-1] - 1), side="right"))] + 0.5) / RATE_STEPS


def calibrated(model: LanguageModel, labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """``model`` with cuts: for each language ``FOREIGN`` of the median phrase rate that texts in other languages have under its
    automaton, or what ``OWN`` of its own texts keep under, if that is more. A text beyond it reads like a foreign one.

    Taken from all distinct labelled texts, each parsed as a whole. Spark counts them by language and step of
    the rate, so what comes to the driver does not grow with the rows. Without texts of its own or of others a language has no cut.
    """
    cuts = np.full(len(model.langs), np.inf)
    if not model.langs:
        return replace(model, cuts=cuts)
    rows = labelled.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col, F.lit(1)).alias("at"))
    judged = predict(rows, model, id_col="at", keep=["lang"], rates=True).filter(F.col("letters") >= LEAST_LETTERS)
    judged = judged.select("at", "lang", F.transform("rates", lambda r: F.floor(r * RATE_STEPS).cast("int")).alias("steps")).distinct()
    own = F.get(F.array(*[F.lit(lang) for lang in model.langs]), F.col("k")) == F.col("lang")
    counts = judged.select("lang", F.posexplode("steps").alias("k", "step")).groupBy("k", own.alias("own"), "step").count()
    steps: dict[tuple[int, bool], dict[int, int]] = {}
    for k, is_own, step, n in counts.collect():
        steps.setdefault((k, is_own), {})[step] = n
    for k in range(len(model.langs)):
        if (k, True) in steps and (k, False) in steps:
            cuts[k] = max(FOREIGN * _quantile(steps[k, False], 0.5), _quantile(steps[k, True], OWN))
    return replace(model, cuts=cuts)


def phrases(model: LanguageModel, windows: list[np.ndarray]) -> np.ndarray:
    """(window, language) -> number of phrases in the greedy parse. All windows advance side by side."""
    counts = np.zeros((len(windows), len(model.langs)), np.int32)
    if not windows or not model.langs:
        return counts
    order = np.argsort([-len(w) for w in windows], kind="stable")
    sizes = np.array([len(windows[i]) for i in order])
    grid = np.zeros((sizes[0], len(windows)), np.int32)
    for column, i in enumerate(order):
        grid[: sizes[column], column] = windows[i]
    langs = len(model.langs)
    starts = np.repeat(model.starts, len(windows)).reshape(langs, len(windows))
    found = np.ones((langs, len(windows)), np.int32)
    state = starts.copy()
    live = len(windows)
    for step in range(sizes[0]):
        while sizes[live - 1] <= step:
            live -= 1
        chars = grid[step, :live]
        to = model.move(state[:, :live], chars)
        missing = to < 0
        if step:
            found[:, :live] += missing
        # A phrase ends; the next one begins with this character, or after it if the sample lacks it.
        again = model.move(starts[:, :live], chars)
        np.copyto(to, np.where(again < 0, starts[:, :live], again), where=missing)
        state[:, :live] = to
    counts[order] = found.T
    return counts


def predict(docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] | list[str] = (), batch_letters: int = 1 << 21, rates: bool = False) -> DataFrame:
    """(id, lang_pred, score, known) of every row, from its whole text and nothing else; with ``keep``, those columns of
    ``docs`` follow, under their names; with ``rates`` also the phrases per letter under each language and the number of
    letters and spaces. ``known`` is false for ``und``, and for a text of ``LEAST_LETTERS`` or more whose rate is
    over the cut of a :func:`calibrated` model; a shorter one is too short to tell. Kept columns that are named like a result
    are not kept.

    ``score`` is the winner's share of the inverse phrase rates, from 1 / number of languages to 1. ``und`` with
    score 0 where the text is null or has no letter, or nothing was learned. Equal phrase counts are settled by
    the order of the language names. Repeated rows each give a row; an empty table gives an empty table; other
    columns are not read. A text is parsed in windows of ``WINDOW`` characters, so memory follows the batch.
    """
    results = ["lang_pred", "score", "known", *(["rates", "letters"] if rates else [])]
    keep = [c for c in keep if c not in results]
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.struct(*keep or [F.lit(0)]).alias("_keep"))
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        space, unknown = m.codes[" "], m.alphabet - 1
        # Code of every character of the basic plane and above: letters without a code are unknown, all else is a space.
        known = np.full(0x110000, -1, np.int32)
        for c, code in m.codes.items():
            known[ord(c)] = code

        def encode(text: str) -> tuple[np.ndarray, bool]:
            points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            codes = known[points]
            if (codes < 0).any():
                for p in np.unique(points[codes < 0]).tolist():
                    known[p] = unknown if chr(p).isalpha() else space
                codes = known[points]
            blank = codes == space
            letters = bool(len(blank)) and not blank.all()
            keep = ~blank
            keep[1:] |= ~blank[:-1]  # the first space of each run stays
            return codes[keep], letters

        for batch in batches:
            names, scores, sure, rated, sized = [], [], [], [], []
            waiting: list[tuple[int, bool]] = []
            windows: list[np.ndarray] = []
            size = 0

            def flush():
                counts = phrases(m, windows)
                lengths = np.array([len(w) for w in windows], np.int64)
                at = 0
                for n, letters in waiting:
                    if not letters or not m.langs:
                        names.append("und")
                        scores.append(0.0)
                        sure.append(False)
                        rated.append([])
                        sized.append(0)
                    else:
                        letters = int(lengths[at : at + n].sum())
                        rate = counts[at : at + n].sum(axis=0) / letters
                        best = int(rate.argmin())
                        names.append(m.langs[best])
                        scores.append(float((1 / rate[best]) / (1 / rate).sum()))
                        sure.append(m.cuts is None or letters < LEAST_LETTERS or bool(rate[best] <= m.cuts[best]))
                        rated.append(rate.tolist())
                        sized.append(letters)
                    at += n
                waiting.clear()
                windows.clear()

            for text in batch.column(1).to_pylist():
                codes, letters = encode(text)
                parts = [codes[i : i + WINDOW] for i in range(0, len(codes), WINDOW)] if letters else []
                windows.extend(parts)
                waiting.append((len(parts), letters))
                size += len(codes)
                if size >= batch_letters:
                    flush()
                    size = 0
            flush()
            columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sure, pa.bool_())]
            columns += [pa.array(rated, pa.list_(pa.float64())), pa.array(sized, pa.int64())] if rates else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], ["_id", "_keep", *results])

    schema = T.StructType([rows.schema["_id"], rows.schema["_keep"]]).add("lang_pred", "string").add("score", "double").add("known", "boolean")
    schema = schema.add("rates", T.ArrayType(T.DoubleType())).add("letters", "long") if rates else schema
    found = rows.mapInArrow(label, schema)
    own = [] if id_col in keep else [F.col("_id").alias(id_col)]
    return found.select(*own, *([F.col("_keep.*")] if keep else []), *results)
