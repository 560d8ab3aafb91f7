"""Source divergence audit: how each source's term shares differ within a language.

Late string materialization. A first scan counts the terms of a few documents at
a time as strings and ships only fixed-width numbers: digests of terms and
sources with their counts, bundled by block of digests. A block adds up its
bundles and keeps the terms in enough documents. Their low bits, a table of fixed
size, are broadcast; a second scan ships the texts of those terms, and a block
takes the least and the greatest string of every digest. Where the two differ,
several terms share the digest: it is split, and its terms are counted anew by
their strings. Texts of sources are joined back for the groups alone.

A block has all counts of its terms, gives each pair of sources one partial sum
(numpy over its terms), so pairs of sources are never made per term, and each
source its highest terms.

Defined results: null text, lang and source count as the empty text; a group
(lang, source) without terms has the shares of zero counts; a language without
kept terms gives pairs of value 0 and no term rows; repeated rows count each
time; very long texts are read whole; ties rank by item; an empty table gives no
rows; only the text, lang and source columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.bits import bit_table, held
from visitlens.llm.common import cut_lineage

#: Bytes that are not part of a term (A-Z are lower-cased first).
NOT_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS, TOP, SMOOTH, UNIT = 30, 50, 5, 1_000_000_000
PASS_BYTES = 8 << 20
#: Rows (term, source) in one block, about; cells of the matrix that a block holds at once.
#: Bytes of text for each block of digests; cells of the matrix that a block holds at once.
BLOCK_BYTES, CELLS = 8 << 20, 1 << 20
#: Sources whose pairs a block sums at once; languages with more take the block once a tile.
TILE = 1000
Digest = Callable[[bytes], int]


def term_digest(term: bytes) -> int:
    """64-bit digest of a term."""
    return xxhash.xxh64_intdigest(term)


def _terms(part: pa.RecordBatch, digest: Digest) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Document and term number of every term, the terms, and their digests."""
    pieces = pc.split_pattern_regex(pc.ascii_lower(part.column("text")), pattern=NOT_TERM)
    flat = pc.list_flatten(pieces)
    real = pc.not_equal(flat, "")
    terms = flat.filter(real).dictionary_encode()
    doc = pc.list_parent_indices(pieces).filter(real).to_numpy().astype(np.int64)
    names = terms.dictionary
    digests = np.fromiter((digest(t) for t in names.cast(pa.binary()).to_pylist()), np.uint64, len(names))
    return doc, terms.indices.to_numpy().astype(np.int64), names, digests.view(np.int64)


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(values, kind))


def _per_document(part: pa.RecordBatch, digest: Digest, wanted: np.ndarray | None) -> tuple:
    """Language of each document, and (document, term, count) of its distinct terms."""
    doc, code, terms, digests = _terms(part, digest)
    if wanted is not None:
        often = held(wanted, digests)[code]
        doc, code = doc[often], code[often]
    size = max(len(terms), 1)
    both, n = np.unique(doc * size + code, return_counts=True)
    langs = part.column("lang").dictionary_encode()
    return langs.dictionary, langs.indices.to_numpy().astype(np.int64), both // size, both % size, n, terms, digests


def _bundled(part: pa.RecordBatch, digest: Digest, n_blocks: int) -> pa.RecordBatch:
    """Counts of a few documents: one row per language and block of digests."""
    names, lang_of, doc, code, n, terms, digests = _per_document(part, digest, None)
    size, block_of = max(len(terms), 1), (digests.view(np.uint64) % np.uint64(n_blocks)).astype(np.int64)
    src, src_of = np.unique(part.column("src").to_numpy(), return_inverse=True)
    # (language, term, source) in order of language, block and term
    rank = np.empty(len(terms), np.int64)
    rank[np.argsort(block_of, kind="stable")] = np.arange(len(terms))
    term = lang_of[doc] * size + rank[code]
    key, back = np.unique(term * len(src) + src_of[doc], return_inverse=True)
    own, first = np.unique(key // len(src), return_index=True)
    by_rank = np.argsort(rank)
    lang, code = own // size, by_rank[own % size] if len(terms) else own
    group = np.flatnonzero(np.diff(lang * n_blocks + block_of[code], prepend=-1)) if len(own) else np.zeros(0, np.int64)
    ends, entry_ends = np.append(group[1:], len(own)), np.append(first[group[1:]], len(key))
    if not len(own):
        ends = entry_ends = np.zeros(0, np.int64)
    width = np.diff(np.append(first, len(key)))
    return pa.RecordBatch.from_arrays(
        [names.take(pa.array(lang[group])), pa.array(block_of[code[group]] if len(own) else group),
         _lists(digests[code] if len(own) else own, ends, pa.int64()),
         _lists(np.bincount(np.searchsorted(own, term), minlength=len(own)), ends, pa.int32()),
         _lists(width, ends, pa.int32()), _lists(src[key % len(src)], entry_ends, pa.int64()),
         _lists(np.bincount(back, n, len(key)).astype(np.int64), entry_ends, pa.int32())],
        ["lang", "block", "digests", "docs", "width", "src", "n"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few MB of documents at a time."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy())
        at = 0
        while at < batch.num_rows:
            stop = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PASS_BYTES)), at + 1)
            yield batch.slice(at, stop - at)
            at = stop


_BUNDLE = "lang string, block bigint, digests array<bigint>, docs array<int>, width array<int>, src array<bigint>, n array<int>"


def term_bundles(docs: DataFrame, n_blocks: int, digest: Digest = term_digest) -> DataFrame:
    """Per language and block of digests: digests, documents with each, numbers of
    sources, and the sources' digests and counts, of a few documents at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (_bundled(part, digest, n_blocks) for part in _parts(batches))

    return docs.select("lang", "src", "text").mapInArrow(run, _BUNDLE)


def _flat(table: pa.Table, name: str) -> np.ndarray:
    """All numbers of a list column."""
    return _items(table, name).to_numpy() if table.num_rows else np.zeros(0, np.int64)


def _items(table: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays([c.flatten() for c in table.column(name).chunks if len(c)])


def kept_counts(bundles: DataFrame, min_docs: int) -> DataFrame:
    """Per language and block: digests of terms in at least ``min_docs`` documents,
    with the numbers, digests and counts of their sources."""
    def run(table: pa.Table) -> pa.Table:
        digests, back = np.unique(_flat(table, "digests"), return_inverse=True)
        docs = np.bincount(back, _flat(table, "docs"), len(digests))
        place = np.cumsum(docs >= min_docs) - 1
        term = np.repeat(back, _flat(table, "width"))
        often = docs[term] >= min_docs
        src, src_of = np.unique(_flat(table, "src")[often], return_inverse=True)
        key, back = np.unique(place[term[often]] * max(len(src), 1) + src_of, return_inverse=True)
        n = np.bincount(back, _flat(table, "n")[often], len(key)).astype(np.int64)
        digests = digests[docs >= min_docs]
        width = np.bincount(key // max(len(src), 1), minlength=len(digests))
        return pa.table({
            "lang": table.column("lang")[:1], "block": table.column("block")[:1], "digests": _lists(digests, [len(digests)], pa.int64()),
            "width": _lists(width, [len(width)], pa.int32()), "src": _lists(src[key % max(len(src), 1)], [len(key)], pa.int64()),
            "n": _lists(n, [len(n)], pa.int64())})

    return bundles.groupBy("lang", "block").applyInArrow(
        run, "lang string, block bigint, digests array<bigint>, width array<int>, src array<bigint>, n array<bigint>")


def term_texts(docs: DataFrame, wanted: np.ndarray, n_blocks: int, digest: Digest = term_digest) -> DataFrame:
    """Per language and block: digests and texts of the terms whose bit is set."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            names, lang_of, doc, code, _, terms, digests = _per_document(part, digest, shared.value)
            block_of = (digests.view(np.uint64) % np.uint64(n_blocks)).astype(np.int64)
            own = np.unique(lang_of[doc] * max(len(terms), 1) + code)
            lang, code = own // max(len(terms), 1), own % max(len(terms), 1)
            order = np.lexsort((block_of[code], lang))
            lang, code = lang[order], code[order]
            group = np.flatnonzero(np.diff(lang * n_blocks + block_of[code], prepend=-1)) if len(own) else np.zeros(0, np.int64)
            ends = np.append(group[1:], len(own)) if len(own) else group
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(lang[group])), pa.array(block_of[code[group]]), _lists(digests[code], ends, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), terms.take(pa.array(code)).cast(pa.string()))],
                ["lang", "block", "digests", "terms"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, block bigint, digests array<bigint>, terms array<string>")


_NAMED = "lang string, block bigint, terms array<string>, width array<int>, src array<bigint>, n array<bigint>, clash array<bigint>"


def named_counts(counts: DataFrame, texts: DataFrame) -> DataFrame:
    """``counts`` with the terms' texts; ``clash`` has the digests that several terms
    share, which the other columns leave out."""
    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        digests, width = _flat(own, "digests"), _flat(own, "width")
        flat = pa.table({"digest": _flat(found, "digests"), "term": _items(found, "terms")})
        flat = flat.take(pc.sort_indices(flat, sort_keys=[("digest", "ascending"), ("term", "ascending")]))
        first = np.searchsorted(flat.column("digest").to_numpy(), digests)
        last = np.searchsorted(flat.column("digest").to_numpy(), digests, "right") - 1
        lo, hi = (flat.column("term").combine_chunks().take(pa.array(x)) for x in (first, last))
        alone = pc.equal(lo, hi).to_numpy(zero_copy_only=False)
        entry = np.repeat(alone, width)
        return pa.table({
            "lang": own.column("lang"), "block": own.column("block"),
            "terms": pa.ListArray.from_arrays(pa.array([0, int(alone.sum())], pa.int32()), lo.filter(pa.array(alone))),
            "width": _lists(width[alone], [int(alone.sum())], pa.int32()), "src": _lists(_flat(own, "src")[entry], [int(entry.sum())], pa.int64()),
            "n": _lists(_flat(own, "n")[entry], [int(entry.sum())], pa.int64()),
            "clash": _lists(digests[~alone], [int((~alone).sum())], pa.int64())})

    filled = counts.filter(F.size("digests") > 0)
    return filled.groupBy("lang", "block").cogroup(texts.groupBy("lang", "block")).applyInArrow(
        lambda own, found: run(own, found) if own.num_rows else pa.table(_schema_of_nothing()), _NAMED)


def _schema_of_nothing() -> dict:
    kinds = {"lang": pa.string(), "block": pa.int64(), "terms": pa.list_(pa.string()), "width": pa.list_(pa.int32()),
             "src": pa.list_(pa.int64()), "n": pa.list_(pa.int64()), "clash": pa.list_(pa.int64())}
    return {k: pa.array([], t) for k, t in kinds.items()}


def split_counts(docs: DataFrame, clash: DataFrame, n_blocks: int, min_docs: int, digest: Digest) -> DataFrame:
    """Like ``named_counts``, for the terms whose digests (lang, digest) are shared:
    counted by their strings."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(clash.select("digest")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            _, _, doc, code, n, terms, digests = _per_document(part, digest, shared.value)
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [part.column("lang").take(at), part.column("src").take(at), pa.array(digests[code]), terms.take(pa.array(code)).cast(pa.string()),
                 pa.array(n)], ["lang", "src", "digest", "term", "n"])

    met = docs.select("lang", "src", "text").mapInArrow(run, "lang string, src bigint, digest bigint, term string, n bigint").join(
        clash, ["lang", "digest"], "left_semi")
    by = met.groupBy("lang", "term", "src").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs"))
    terms = by.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("src", "n")).alias("by")).filter(F.col("docs") >= min_docs)
    return terms.select("lang", F.pmod(F.xxhash64("term"), F.lit(n_blocks)).alias("block"), F.array("term").alias("terms"),
                        F.array(F.size("by")).alias("width"), F.col("by.src").alias("src"), F.col("by.n").alias("n"),
                        F.array().cast("array<bigint>").alias("clash"))


def _shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (count + SMOOTH) / whole) in 64 bits: long division by thousands."""
    out, rest = np.divmod(counts + SMOOTH, whole)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def _block(told: pa.Table, rows: pa.Table, tile: int, top: int) -> pa.Table:
    """Pair sums and highest terms of one block: ``told`` are the language's groups."""
    names = told.column("source").to_pylist()
    order = sorted(range(len(names)), key=lambda i: names[i].encode())
    names, size = [names[i] for i in order], len(names)
    src = told.column("group").to_numpy()[order]
    # one more column: the language as a whole
    whole = np.append(told.column("whole").to_numpy()[order], told.column("lang_whole").to_numpy()[0]).astype(np.int64)
    terms = _items(rows, "terms") if rows.num_rows else pa.array([], pa.string())
    width, n = _flat(rows, "width"), _flat(rows, "n")
    by_src = np.argsort(src)
    owner = by_src[np.searchsorted(src[by_src], _flat(rows, "src"))] if len(n) else np.zeros(0, np.int64)
    starts, row = np.concatenate(([0], np.cumsum(width))), np.arange(len(n))
    of_term = np.repeat(np.arange(len(width)), width)
    mine = range(tile * TILE, min((tile + 1) * TILE, size))
    sums = np.zeros((len(mine), size), np.int64)
    best = [(row[:0], row[:0], row[:0])]
    step = max(1, CELLS // (size + 1))
    for k in range(0, len(starts) - 1, step):
        stop = min(k + step, len(starts) - 1)
        part = slice(starts[k], starts[stop])
        term = np.repeat(np.arange(stop - k), np.diff(starts[k:stop + 1]))
        counts = np.zeros((stop - k, size + 1), np.int64)
        counts[term, owner[part]] = n[row[part]]
        counts[:, size] = counts[:, :size].sum(axis=1)
        p = _shares(counts, whole)
        for i in mine:
            sums[i - mine.start, i + 1:] += np.abs(p[:, i + 1:size] - p[:, i:i + 1]).sum(axis=0)
        above = p[term, owner[part]] - p[term, size]
        more = (above > 0) & (tile == 0)
        best.append((row[part][more], owner[part][more], above[more]))
    one, two = np.nonzero(np.arange(size)[None, :] > np.arange(mine.start, mine.stop)[:, None])
    at, owner, value = (np.concatenate(x) for x in zip(*best, strict=True))
    found = pa.table({"owner": owner, "value": value, "term": terms.take(pa.array(of_term[at]))})
    found = found.take(pc.sort_indices(found, sort_keys=[("owner", "ascending"), ("value", "descending"), ("term", "ascending")]))
    owner = found.column("owner").to_numpy()
    found = found.filter(pa.array(np.arange(len(owner)) - np.searchsorted(owner, owner) < top))
    names = pa.array(names, pa.string())
    return pa.table({
        "part": pa.array(["pair"] * len(one) + ["term"] * found.num_rows, pa.string()),
        "source": pa.concat_arrays([names.take(pa.array(one + mine.start)), names.take(found.column("owner").combine_chunks())]),
        "item": pa.concat_arrays([names.take(pa.array(two)), found.column("term").combine_chunks().cast(pa.string())]),
        "value": pa.concat_arrays([pa.array(sums[one, two]), found.column("value").combine_chunks().cast(pa.int64())])})


def _blocks(told: DataFrame, rows: DataFrame, top: int) -> DataFrame:
    """(part, lang, source, item, value) of every block and tile."""
    def run(told: pa.Table, rows: pa.Table) -> pa.Table:
        out = _block(told, rows, told.column("tile")[0].as_py(), top)
        lang = told.column("lang").combine_chunks().take(pa.array(np.zeros(out.num_rows, np.int64)))
        return out.append_column("lang", lang).select(["part", "lang", "source", "item", "value"])

    keys = ("lang", "block", "tile")
    return told.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(
        run, "part string, lang string, source string, item string, value bigint")


def source_digests(docs: DataFrame) -> DataFrame:
    """(lang, source, text) rows with ``src``, a digest that no two sources share."""
    names = cut_lineage(docs.select("source").distinct())
    seed = 0
    while not names.groupBy(F.xxhash64("source", F.lit(seed))).count().filter("count > 1").isEmpty():
        seed += 1
    return docs.withColumn("src", F.xxhash64("source", F.lit(seed)))


def divergence(docs: DataFrame, digest: Digest = term_digest, min_docs: int = MIN_DOCS, top: int = TOP,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, source, part, item, value, rank: distances to the other sources of the
    language (``pair``) and the ``top`` terms above the language's share (``term``)."""
    docs = source_digests(docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]))
    n_blocks = 1 + (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes
    counts = cut_lineage(kept_counts(term_bundles(docs, n_blocks, digest), min_docs))
    wanted = bit_table(counts.select(F.explode("digests").alias("digest")))
    rows = cut_lineage(named_counts(counts, term_texts(docs, wanted, n_blocks, digest)))
    clash = rows.select("lang", F.explode("clash").alias("digest"))
    if not clash.isEmpty():
        rows = cut_lineage(rows.unionByName(split_counts(docs, cut_lineage(clash), n_blocks, min_docs, digest)))
    rows = rows.drop("clash")
    met = rows.select("lang", F.explode(F.arrays_zip("src", "n")).alias("e")).select("lang", "e.src", "e.n")
    sizes = rows.groupBy("lang").agg(F.sum(F.size("terms")).alias("v"))
    known = docs.select("lang", "source", "src").distinct()
    groups = known.join(met.groupBy("lang", "src").agg(F.sum("n").alias("n")), ["lang", "src"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    of_lang = groups.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count(F.lit(1)).alias("sources")).join(sizes, "lang", "left")
    smooth = SMOOTH * F.coalesce("v", F.lit(0))
    # a language without kept terms has nothing to divide
    told = groups.join(of_lang, "lang").select(
        "lang", "source", F.col("src").alias("group"), "sources", F.greatest(F.col("n") + smooth, F.lit(1)).alias("whole"),
        F.greatest(F.col("lang_n") + smooth, F.lit(1)).alias("lang_whole"))
    told = cut_lineage(told)
    tiles = F.floor((F.col("sources") - 1) / TILE).cast("int")
    # each block of a language that has terms, and one for every language
    used = rows.select("lang", "block").unionByName(told.select("lang", F.lit(0).cast("bigint").alias("block"))).distinct()
    told = told.join(used, "lang").withColumn("tile", F.explode(F.sequence(F.lit(0), tiles)))
    many = told.groupBy("lang").agg(F.max("tile").alias("last"))
    placed = rows.join(many, "lang").withColumn("tile", F.explode(F.sequence(F.lit(0), "last"))).drop("last")
    told = told.drop("sources")
    found = cut_lineage(_blocks(told.toDF(*told.columns), placed.toDF(*placed.columns), top))
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = pairs.select("lang", F.explode(F.array(F.struct("source", "item"), F.struct(
        F.col("item").alias("source"), F.col("source").alias("item")))).alias("e"), "value").select(
        "lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (both.unionByName(found.filter("part = 'term'").select("lang", "source", "part", "item", "value"))
            .withColumn("rank", F.row_number().over(ranked)).filter((F.col("part") == "pair") | (F.col("rank") <= top))
            .select("lang", "source", "part", "item", "value", "rank"))
