"""SentencePiece encoding and decoding as relations: the substrings of every distinct word are joined to the piece
table, the edges of a word are gathered into its lattice, and a fold over the lattice picks the pieces.

For unigram models the fold is Viterbi's best path. BPE models do not take the best path but merge the best neighbours
first, so for them the fold walks the same lattice by merges; both give the library's ids. Built-in functions only, but for
words of a BPE model that are too long for the fold.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise
from string import punctuation

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.llm.common import written
from shoptide.llm.exact_dedup import LOCATOR, located

SPACE = "▁"
# Words of so many characters fold over a bitmap of boundaries in one long; longer ones are merged one by one.
BITMAP_CHARS = 62
# Words whose edges a task holds in a hash table before it sorts them to gather them.
WORDS_AT_ONCE = 1 << 16
# Distinct words of a partition, whose edges fit a task many times over.
WORDS_A_PART, LEAST_PARTS = 1 << 13, 64
# So many of the most frequent words, of at most BITMAP_CHARS characters, are broadcast in encoded form; all others are joined
# by a shuffle.
FREQUENT_WORDS = 1 << 17
UNKNOWN_PENALTY = 10.0
# So many characters from a place on tell how long a piece from there can be.
PREFIX = 3
# An edge of a word of at most BITMAP_CHARS characters as one long: the rank of its score, start, length and id + 1 (0: none).
RANK_BITS, PLACE_BITS, ID_BITS = 21, 6, 30


@dataclass
class PieceModel:
    """A sentencepiece model as a table: pieces (piece, id, score, rank, back) hold the normal pieces, the best score's rank being 0 (back:
    see :func:`backward`), reach (prefix, longest) the length of the longest piece with these PREFIX first characters, byte_ids the ids of
    the 256 byte pieces, solo the ASCII characters that are in no piece of several characters, closing the ASCII
    marks that follow a letter in no piece."""

    pieces: DataFrame
    decoded: DataFrame
    byte_ids: list[int]
    reach: DataFrame
    bpe: bool
    solo: str
    closing: str
    least_score: float
    scores: dict[str, tuple[int, float]]


def load(spark: SparkSession, path: str | None = None, proto: bytes | None = None) -> PieceModel:
    """Read a model file with identity normalisation, a leading space mark and byte fallback."""
    from sentencepiece import sentencepiece_model_pb2 as model_pb2

    model = model_pb2.ModelProto()
    if proto is None:
        with open(path, "rb") as file:
            proto = file.read()
    model.ParseFromString(proto)
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or not spec.add_dummy_prefix or spec.remove_extra_whitespaces:
        raise ValueError("only models with identity normalisation and a leading space mark are supported")
    normal = [(p.piece, i, float(p.score)) for i, p in enumerate(model.pieces) if p.type == p.NORMAL]
    if any(SPACE in p.lstrip(SPACE) for p, _, _ in normal):
        raise ValueError("a piece reaches over the start of a word")
    by_byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == p.BYTE}
    inner = {c for p, _, _ in normal if len(p) > 1 for c in p}
    solo = "".join(chr(c) for c in range(1, 128) if chr(c) not in inner and c != 32)
    after_letter = {b for p, _, _ in normal for a, b in pairwise(p) if a.isalpha()}
    closing = "".join(c for c in punctuation if c not in after_letter and c not in solo)
    rank = {score: k for k, score in enumerate(sorted({score for _, _, score in normal}, reverse=True))}
    if len(rank) >= 1 << RANK_BITS or len(model.pieces) >= 1 << ID_BITS:
        raise ValueError("the model has more pieces than an edge can name")
    reach: dict[str, int] = {}
    for p, _, _ in normal:
        if len(p) >= PREFIX:
            reach[p[:PREFIX]] = max(reach.get(p[:PREFIX], 0), len(p))
    surfaces = [(i, p.replace(SPACE, " ").encode()) for p, i, _ in normal] + [(i, bytes([b])) for b, i in by_byte.items()]
    scores = {p: (i, s) for p, i, s in normal}
    bpe = model.trainer_spec.model_type == 2
    back = backward(scores) if bpe else set()
    return PieceModel(
        spark.createDataFrame([(p, i, s, rank[s], p in back) for p, i, s in normal], "piece string, id int, score double, rank long, back boolean"), spark.createDataFrame(surfaces, "id int, surface binary"),
        [by_byte[b] for b in range(256)], spark.createDataFrame(list(reach.items()), "prefix string, longest int"), bpe, solo, closing, min(s for _, _, s in normal), scores)


def words_of(text: Column, model: PieceModel) -> Column:
    """The words of a text in order: no piece reaches from one into the next. A word begins with its space marks; it ends
    at the latest before the next, or between a letter and a mark that follows letters in no piece; characters that
    no longer piece holds are words of their own."""
    code = lambda chars: "".join(f"\\x{ord(c):02x}" for c in chars)
    alone, closing = code(model.solo), code(model.closing)
    one = f"[{alone}]|" if alone else ""
    # Possessive, and each character is looked at once: a mark goes on with the word unless a letter stands before it.
    further = f"(?:[^{SPACE}{alone}{closing}]++|(?<!\\p{{L}})[{closing}]++)*+" if closing else f"[^{SPACE}{alone}]*+"
    pattern = f"{one}{SPACE}*+[^{SPACE}{alone}]{further}|{SPACE}++"
    return F.regexp_extract_all(F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE))), F.lit(pattern), F.lit(0))


def encode_words(words: DataFrame, model: PieceModel) -> DataFrame:
    """(word, ids) for distinct words. ``words`` is shuffled by word once; its substrings meet the piece table, whose size is
    the model's, and are gathered again where they are."""
    return _merged_bitmap(packed_lattice(words, model), model) if model.bpe else lattice_of(words, model).select("word", _viterbi().alias("ids"))


def edges_of(words: DataFrame, model: PieceModel) -> DataFrame:
    """(word, n, start, len, piece, id, score, rank, back): the pieces found in every distinct word, and all its characters. Substrings
    are no longer than the longest piece that begins as they do."""
    # Gathering is by a hash table of words: sorting the edges of all words costs more than all the rest.
    words.sparkSession.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(WORDS_AT_ONCE))
    sized = words.select("word", F.char_length("word").alias("n"))
    at = sized.select("word", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("start"))
    at = at.withColumn("prefix", F.expr(f"substring(word, start + 1, {PREFIX})")).join(F.broadcast(model.reach), "prefix", "left")
    most = F.least(F.coalesce("longest", F.lit(PREFIX - 1)), F.col("n") - F.col("start"))
    spans = at.select("word", "n", "start", F.explode(F.sequence(F.lit(1), most)).alias("len"))
    spans = spans.withColumn("piece", F.expr("substring(word, start + 1, len)"))
    return spans.join(F.broadcast(model.pieces), "piece", "left").filter("id IS NOT NULL OR len = 1")


def bytes_of(piece: Column, model: PieceModel) -> Column:
    """The ids of the byte pieces of a string."""
    code = F.hex(F.encode(piece, "UTF-8"))
    table = F.array(*[F.lit(i) for i in model.byte_ids])
    return F.transform(F.sequence(F.lit(1), (F.length(code) / 2).cast("int")), lambda k: F.get(table, F.conv(F.substring(code, k * 2 - 1, F.lit(2)), 16, 10).cast("int")))


def lattice_of(words: DataFrame, model: PieceModel) -> DataFrame:
    """(word, n, edges): the pieces found in every distinct word, by score and then from left to right."""
    edges = edges_of(words, model)
    edges = edges.withColumn("ids", F.when(F.col("id").isNotNull(), F.array("id")).otherwise(bytes_of(F.col("piece"), model)))
    edges = edges.withColumn("score", F.coalesce("score", F.lit(model.least_score - UNKNOWN_PENALTY)))
    edge = F.struct((-F.col("score")).alias("cost"), "start", "len", "ids")
    return edges.groupBy("word", "n").agg(F.sort_array(F.collect_list(edge)).alias("edges"))


def packed_lattice(words: DataFrame, model: PieceModel) -> DataFrame:
    """(word, n, edges, back): as :func:`lattice_of`, of words of at most BITMAP_CHARS characters; an edge is three longs. ``back``
    tells whether one is a piece of :func:`backward`."""
    edge = F.coalesce("rank", F.lit((1 << RANK_BITS) - 1).cast("long"))
    for part, bits in ((F.col("start"), PLACE_BITS), (F.col("len"), PLACE_BITS), (F.coalesce(F.col("id") + 1, F.lit(0)), ID_BITS)):
        edge = F.shiftleft(edge, bits).bitwiseOR(part.cast("long"))
    # Both ends of the edge, and all boundaries inside it, as bits.
    ends, inner = F.expr("shiftleft(1L, start) | shiftleft(1L, start + len)"), F.expr("shiftleft(1L, start + len) - shiftleft(2L, start)")
    spans = edges_of(words, model).select("word", "n", edge.alias("edge"), ends.alias("ends"), inner.alias("inner"), "back")
    return spans.groupBy("word", "n").agg(F.sort_array(F.collect_list(F.struct("edge", "ends", "inner"))).alias("edges"), F.coalesce(F.bool_or("back"), F.lit(False)).alias("back"))


def _merged_bitmap(lattice: DataFrame, model: PieceModel) -> DataFrame:
    """Merges with the boundaries of the current symbols as bits of a long. An edge can be merged when both its ends are
    boundaries and one boundary lies inside; edges stand in the order of their scores, then from left to right. They
    are gone through once, but in words with a piece of :func:`backward` from the first one again after every merge."""
    all_ends, fits = "shiftleft(1L, n + 1) - 1L", "(m & e.ends) = e.ends AND bit_count(m & e.inner) = 1"
    place = (1 << PLACE_BITS) - 1
    pair = f"named_struct('start', shiftright(e.edge, {PLACE_BITS + ID_BITS}) & {place}, 'id', e.edge & {(1 << ID_BITS) - 1})"
    last = f"sort_array(transform(filter(edges, e -> (m & e.ends) = e.ends AND (m & e.inner) = 0), e -> {pair}))"
    once = f"aggregate(edges, {all_ends}, (m, e) -> if({fits}, m & ~e.inner, m), m -> {last})"
    anew = f"aggregate(sequence(1, greatest(n - 1, 1)), {all_ends}, (m, k) -> coalesce(m & ~get(filter(edges, e -> {fits}), 0).inner, m), m -> {last})"
    # An edge without id is one character, which is in no piece.
    alone = lambda e: bytes_of(F.substring(F.col("word"), e.start.cast("int") + 1, F.lit(1)), model)
    ids = F.transform(F.expr(f"if(back, {anew}, {once})"), lambda e: F.when(e.id > 0, F.array(e.id.cast("int") - 1)).otherwise(alone(e)))
    return lattice.select("word", F.flatten(ids).alias("ids"))


def merged(word: str, scores: dict[str, tuple[int, float]]) -> list[str]:
    """The symbols of a word after all merges: the neighbours that make the piece with the best score first, the leftmost of
    equal ones. Takes time in proportion to the word's length, but for a logarithm."""
    symbols: list[str] = list(word)
    before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
    heap: list[tuple[float, int, int, int]] = []

    def push(left: int, right: int) -> None:
        if left >= 0 and right >= 0 and (found := scores.get(symbols[left] + symbols[right])):
            heapq.heappush(heap, (-found[1], left, right, len(symbols[left]) + len(symbols[right])))

    for i in range(len(symbols) - 1):
        push(i, i + 1)
    while heap:
        _, left, right, size = heapq.heappop(heap)
        # One of the two has been merged with another since.
        if not symbols[left] or not symbols[right] or after[left] != right or len(symbols[left]) + len(symbols[right]) != size:
            continue
        symbols[left] += symbols[right]
        symbols[right] = ""
        after[left] = after[right]
        if after[right] >= 0:
            before[after[right]] = left
        push(before[left], left)
        push(left, after[left])
    return [s for s in symbols if s]


def backward(scores: dict[str, tuple[int, float]]) -> set[str]:
    """The pieces whose score is not less than those of the two that they are merged from.

    Which two these are does not depend on the word: until they are merged nothing reaches over their ends, so they are
    what remains of the piece's own characters before its last merge. In a word without such pieces a merge makes
    possible only merges of lesser scores, so all come in the order of the word's edges.
    """
    found = set()
    for piece in list(scores):
        own = scores.pop(piece)
        parts = merged(piece, scores)
        scores[piece] = own
        if len(parts) == 2 and any(len(part) > 1 and scores[part][1] <= own[1] for part in parts):
            found.add(piece)
    return found


def _merged_long(words: DataFrame, model: PieceModel) -> DataFrame:
    """(word, ids, round_trip) of long words, merged by a queue of neighbours. They are cut before between characters that stand
    side by side in no piece, so that a text without spaces comes in short stretches."""
    scores, byte_ids = model.scores, model.byte_ids
    beside = {pair for piece in scores for pair in pairwise(piece)}
    surface = {i: p.replace(SPACE, " ").encode() for p, (i, _) in scores.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(batch.num_rows):
                word = batch.column(0)[start].as_py()
                ids: list[int] = []
                first = 0
                for at in range(1, len(word) + 1):
                    if at == len(word) or (word[at - 1], word[at]) not in beside:
                        for symbol in merged(word[first:at], scores):
                            ids += [scores[symbol][0]] if symbol in scores else [byte_ids[b] for b in symbol.encode()]
                        first = at
                same = b"".join(surface[i] for i in ids) == word.replace(SPACE, " ").encode()
                columns = [pa.array([word], pa.string()), pa.array([ids], pa.list_(pa.int32())), pa.array([same])]
                yield pa.RecordBatch.from_arrays(columns, ["word", "ids", "round_trip"])

    return words.select("word").mapInArrow(run, "word string, ids array<int>, round_trip boolean")


def _viterbi() -> Column:
    """Best path: the fold keeps for every end the least cost and the edge that it came by; then it walks back."""
    best = ("aggregate(sequence(1, n), array(named_struct('cost', 0D, 'start', 0, 'ids', array(0))), (best, i) -> array_append(best, "
            "array_min(transform(filter(edges, e -> e.start + e.len = i), e -> named_struct('cost', get(best, e.start).cost + e.cost, 'start', e.start, 'ids', e.ids)))))")
    return F.expr(
        f"aggregate(sequence(1, n), named_struct('at', n, 'best', {best}, 'ids', cast(array() AS array<int>)), (s, k) -> if(s.at = 0, s, named_struct("
        "'at', get(s.best, s.at).start, 'best', s.best, 'ids', concat(get(s.best, s.at).ids, s.ids))), s -> s.ids)")


def decode(rows: DataFrame, model: PieceModel, keys: list[str], ids: str = "ids") -> DataFrame:
    """(keys, surface): the bytes that the ids of a row stand for, with the leading space mark as a space. Ids that are not
    in the table (control pieces) stand for nothing."""
    parts = rows.select(*keys, F.posexplode(ids).alias("at", "id")).join(F.broadcast(model.decoded), "id")
    joined = F.expr("unhex(array_join(transform(sort_array(collect_list(struct(at, surface))), p -> hex(p.surface)), ''))")
    return parts.groupBy(*keys).agg(joined.alias("surface"))


def dictionary(words: DataFrame, model: PieceModel) -> DataFrame:
    """(word, ids, round_trip) of distinct words: ids, and whether they decode to the word's own bytes. Words of a BPE
    model that are over BITMAP_CHARS characters have no lattice: the fold would be quadratic, see :func:`_merged_long`."""
    short = words.filter(F.char_length("word") <= BITMAP_CHARS) if model.bpe else words
    back = decode(encode_words(short, model), model, ["word", "ids"])
    found = back.select("word", "ids", (F.col("surface") == F.encode(F.replace(F.col("word"), F.lit(SPACE), F.lit(" ")), "UTF-8")).alias("round_trip"))
    return found.unionByName(_merged_long(words.filter(F.char_length("word") > BITMAP_CHARS), model)) if model.bpe else found


def encode(docs: DataFrame, model: PieceModel, *, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT_WORDS) -> tuple[DataFrame, DataFrame]:
    """Two tables: all rows of ``docs`` as (_id, file, row), and one row (_id, file, row, pos, word, ids, round_trip) for
    every word of every text. A null text has no words, nor has an empty one. Repeated rows are told apart by their
    place (file, row); null ids are kept; other columns are not read; an empty table gives empty tables. Texts and
    words may have any length.

    Every distinct word is encoded once. The ``frequent`` most frequent words, a fixed number, reach the texts by a
    broadcast, so that hot words are never shuffled; the others by a join on the word.
    """
    # A file's name is carried as its hash.
    rows = located(docs, id_col, text_col).withColumn("file", F.xxhash64("file"))
    text = F.when(F.col("_text") != "", F.col("_text"))
    said = rows.select("_id", *LOCATOR, F.posexplode(words_of(text, model)).alias("pos", "word"))
    counts = written(said.groupBy("word").count(), "words")
    top = counts.filter(F.char_length("word") <= BITMAP_CHARS).orderBy(F.desc("count"), "word").limit(frequent).select("word")
    common = written(dictionary(top.repartition(LEAST_PARTS, "word"), model), "frequent-words")
    parts = max(LEAST_PARTS, counts.count() // WORDS_A_PART)
    rare = dictionary(counts.join(F.broadcast(common.select("word")), "word", "left_anti").select("word").repartition(parts, "word"), model)
    matched = said.join(F.broadcast(common), "word")
    rest = said.join(F.broadcast(common.select("word")), "word", "left_anti").join(rare, "word")
    columns = ["_id", *LOCATOR, "pos", "word", "ids", "round_trip"]
    return rows.select("_id", *LOCATOR), matched.select(*columns).unionByName(rest.select(*columns))


def assemble(encoded: DataFrame) -> DataFrame:
    """(_id, file, row, ids): the ids of whole texts in order."""
    return encoded.groupBy("_id", *LOCATOR).agg(F.expr("flatten(transform(array_sort(collect_list(struct(pos, ids))), p -> p.ids))").alias("ids"))


def summary(docs: DataFrame, model: PieceModel, *, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT_WORDS) -> DataFrame:
    """One row per row of ``docs``: (id, n_words, n_tokens, ids_digest, round_trip). ``ids_digest`` combines the hashes of
    every word's place and ids; ``round_trip``: decoding gives the text back."""
    rows, encoded = encode(docs, model, id_col=id_col, text_col=text_col, frequent=frequent)
    sums = encoded.groupBy(*LOCATOR).agg(
        F.count("*").alias("n_words"), F.sum(F.size("ids").cast("long")).alias("n_tokens"), F.bit_xor(F.xxhash64("pos", "ids")).alias("ids_digest"), F.bool_and("round_trip").alias("round_trip"))
    zero = F.lit(0).cast("long")
    return rows.join(sums, LOCATOR, "left").select(
        F.col("_id").alias(id_col), F.coalesce("n_words", zero).alias("n_words"), F.coalesce("n_tokens", zero).alias("n_tokens"),
        F.coalesce("ids_digest", zero).alias("ids_digest"), F.coalesce("round_trip", F.lit(True)).alias("round_trip"))
