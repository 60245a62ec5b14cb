"""Exact removal of repeated substrings: suffix arrays over the places where texts can repeat.

A byte goes if some string of ``WIDTH`` bytes that covers it also starts earlier (in a smaller document, or
earlier in the same one).

* **Anchors.** Each window of ``WIDTH`` bytes holds one anchor: the place of the smallest hash of ``GRAM`` bytes in
  it, the leftmost if several. It depends on the window's bytes only, so equal windows have their anchors at the same
  place. About one place in 35 is an anchor. Anchors that occur once in the whole table need no further look.
* **Contexts.** An anchor's context is the stretch of text from the first to the end of the last window that it
  is the anchor of. Equal contexts are one row from the first aggregation on: all occurrences but the first lose all
  their windows.
* **Shards.** Different contexts of one anchor meet in a shard. A shard is one suffix array: places are ranked by
  Larsson and Sadakane's doubling, which sorts only what is not yet told apart; common prefixes follow Kasai's
  rule in the form of irreducible values, which are compared, and reducible ones, which are one less than their
  left neighbour's. Windows of a run with common prefixes of ``WIDTH`` are equal; the first one stays.
* **Merging.** Contexts of a very frequent anchor are dealt over several shards. Each gives its sorted distinct
  windows, and slices of these lists are merged by binary search.

Texts that are equal as a whole are one text; rows of it but the first are removed outright.

Documents are ordered by key; null keys come last, and texts of one key in the order of a hash. Of equal rows one counts as
first. A null text counts as empty. Matches never cross texts. Keys are integers. Other columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm import columns as C
from sievework.session import stored

WIDTH = 100
GRAM = 32
# Contexts of a shard, about; an anchor with more different ones is dealt over several shards.
SHARD_CONTEXTS = 4_000
# Rows that one task makes of a row that occurs very often.
COPIES_PER_TASK = 100_000
_SYMBOLS = 7


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    value = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).cast("bigint").alias("_key"), value.alias("text")).withColumns(
        {"_h1": F.xxhash64("text"), "_h2": F.xxhash64("text", F.lit(1))}
    )


def window_anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors with their windows: place of the anchor, its hash, first window, last window (places in ``data``)."""
    n = len(data)
    none = np.zeros(0, np.int64)
    reach = WIDTH - GRAM + 1
    if n < WIDTH:
        return none, none.astype(np.uint64), none, none
    running = C.prefix_hash(data)
    # The hash of each place, from neighbouring slices of the running one.
    grams = C.mix(C.rebased(running[GRAM:] - running[:-GRAM]))
    best = (grams & ~np.uint64(0xFFFFFFFF)) | np.arange(n - GRAM + 1, dtype=np.uint64)
    size = 1
    while 2 * size <= reach:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if reach > size:
        best = np.minimum(best[: len(best) - (reach - size)], best[reach - size :])
    # Windows that lie within one text.
    inside = np.zeros(n + 1, np.int32)
    long = np.diff(offsets) >= WIDTH
    inside[offsets[:-1][long]] += 1
    inside[offsets[1:][long] - WIDTH + 1] -= 1
    windows = np.flatnonzero(np.cumsum(inside)[: len(best)])
    if not len(windows):
        return none, none.astype(np.uint64), none, none
    anchor = (best[windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    fresh = np.append(True, (anchor[1:] != anchor[:-1]) | (np.diff(windows) > 1))
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(windows)) - 1
    return anchor[first], grams[anchor[first]], windows[first], windows[last]


def _candidates(batches):
    """Per partition: all occurrences of anchors that the partition repeats (known), and one of each anchor."""
    parts: list[list[np.ndarray]] = [[], [], []]
    for part in C.slices(batches):
        data, offsets = C.text_bytes(part.column("text"))
        anchor, gram, _, _ = window_anchors(data, offsets)
        doc = np.searchsorted(offsets, anchor, "right") - 1
        parts[0].append(gram.view(np.int64))
        parts[1].append(part.column("_h1").to_numpy()[doc])
        parts[2].append((anchor - offsets[doc]).astype(np.int32))
    if not parts[0]:
        return
    gram, text, at = (np.concatenate(p) for p in parts)
    order = np.argsort(gram, kind="stable")
    gram, text, at = gram[order], text[order], at[order]
    fresh = np.append(True, gram[1:] != gram[:-1]) if len(gram) else np.zeros(0, bool)
    first = np.flatnonzero(fresh)
    repeated = np.repeat(np.diff(np.append(first, len(gram))) > 1, np.diff(np.append(first, len(gram))))
    for known, chosen in ((True, np.flatnonzero(repeated)), (False, first)):
        for i in range(0, len(chosen), 50_000):
            c = chosen[i : i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram[c]), pa.array(text[c]), pa.array(at[c]), pa.array(np.full(len(c), known))], ["_gram", "_h1", "_at", "_known"]
            )


def _repeated(batches):
    """Occurrences that are known to repeat, and those whose anchor stands in this sorted stream twice."""
    last: tuple | None = None  # the last row that isn't known: gram, text, place, whether it has been given out
    for batch in batches:
        known = batch.column("_known").to_numpy(zero_copy_only=False)
        gram, text, at = (batch.column(c).to_numpy() for c in ("_gram", "_h1", "_at"))
        out = [np.stack([text[known], at[known].astype(np.int64)])]
        gram, text, at = gram[~known], text[~known], at[~known].astype(np.int64)
        if len(gram):
            same = np.append(False, gram[1:] == gram[:-1])
            if last is not None and last[0] == gram[0]:
                same[0] = True
                if not last[3]:
                    out.append(np.array([[last[1]], [last[2]]]))
            give = same | np.append(same[1:], False)
            out.append(np.stack([text[give], at[give]]))
            last = (gram[-1], text[-1], at[-1], bool(give[-1]))
        rows = np.concatenate(out, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1].astype(np.int32))], ["_h1", "_at"])


def _contexts(batches):
    for part in C.slices(batches):
        data, offsets = C.text_bytes(part.column("text"))
        anchor, gram, low, high = window_anchors(data, offsets)
        doc = np.searchsorted(offsets, anchor, "right") - 1
        wanted = part.column("_places")
        owner = np.repeat(np.arange(part.num_rows), wanted.value_lengths().to_numpy())
        places = np.unique(wanted.flatten().to_numpy() + offsets[owner])
        c = np.flatnonzero(np.isin(anchor, places))
        sizes = high[c] + WIDTH - low[c]
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        stretches = pa.py_buffer(np.ascontiguousarray(data[C.ragged(low[c], sizes)]))
        rows = pa.BinaryArray.from_buffers(pa.binary(), len(c), [None, pa.py_buffer(bounds), stretches])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(gram[c].view(np.int64)), pa.array((anchor - low)[c].astype(np.int32)), rows,
                part.column("_key").take(pa.array(doc[c])), part.column("_h1").take(pa.array(doc[c])), pa.array((low - offsets[doc])[c]),
            ],
            ["_gram", "_x", "_context", "_key", "_h1", "_from"],
        )


def packed_symbols(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The ``_SYMBOLS`` symbols from each place on as one number; 0 stands behind a string's end."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(_SYMBOLS, np.int64)]).astype(np.uint64)
    room = ends - np.arange(n)
    key = np.zeros(n, np.uint64)
    for k in range(_SYMBOLS):
        key = (key << np.uint64(9)) | np.where(room > k, padded[k : k + n], np.uint64(0))
    return key


def suffix_array(symbols: np.ndarray, ends: np.ndarray, owner: np.ndarray, key: np.ndarray | None = None) -> np.ndarray:
    """Sorted places of all suffixes of several strings laid end to end; a string's end sorts before all symbols.

    ``symbols`` are bytes plus one, ``ends`` the end of each place's string, ``owner`` its number. Equal
    suffixes are ordered by the number of their string.
    """
    n = len(symbols)
    key = packed_symbols(symbols, ends) if key is None else key
    order = np.argsort(key)
    sorted_key = key[order]
    fresh = np.append(True, sorted_key[1:] != sorted_key[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    depth = _SYMBOLS
    while True:
        # Groups that are not told apart yet: runs of equal rank.
        single = fresh & np.append(fresh[1:], True)
        open_ = np.flatnonzero(~single)
        if not len(open_):
            return order
        members = order[open_]
        onward = members + depth
        beyond = onward >= ends[members]
        second = np.where(beyond, owner[members] - n - 1, rank[np.minimum(onward, n - 1)])
        group = rank[members]
        # Group and second rank as one number: second ranks lie within -2n and n.
        both = group * (3 * n + 2) + (second + 2 * n + 1)
        sorting = np.argsort(both)
        members, both = members[sorting], both[sorting]
        order[open_] = members
        starts = np.append(True, both[1:] != both[:-1])
        fresh[open_] = starts
        rank[members] = open_[np.flatnonzero(starts)[np.cumsum(starts) - 1]]
        depth *= 2


def common_prefixes(
    symbols: np.ndarray, ends: np.ndarray, order: np.ndarray, begins: np.ndarray, key: np.ndarray | None = None
) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``order`` (0 for the first)."""
    n = len(symbols)
    key = packed_symbols(symbols, ends) if key is None else key
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    has = before >= 0
    left_equal = np.zeros(n, bool)
    inner = np.flatnonzero(has & ~begins & ~begins[np.maximum(before, 0)])
    left_equal[inner] = symbols[inner - 1] == symbols[before[inner] - 1]
    irreducible = np.flatnonzero(~left_equal)
    length = np.zeros(len(irreducible), np.int64)
    whole = np.flatnonzero(has[irreducible])
    one, other = irreducible[whole], before[irreducible[whole]]
    room = np.minimum(ends[one] - one, ends[other] - other)
    # In steps of several symbols as long as they agree, then one by one.
    active = np.arange(len(whole))
    while len(active):
        done = length[whole[active]]
        active = active[done + _SYMBOLS <= room[active]]
        done = length[whole[active]]
        active = active[key[one[active] + done] == key[other[active] + done]]
        length[whole[active]] += _SYMBOLS
    active = whole
    while len(active):
        i = irreducible[active] + length[active]
        j = before[irreducible[active]] + length[active]
        alive = (i < ends[irreducible[active]]) & (j < ends[before[irreducible[active]]])
        alive[alive] = symbols[i[alive]] == symbols[j[alive]]
        active = active[alive]
        length[active] += 1
    last = np.cumsum(~left_equal) - 1
    prefix = length[last] - (np.arange(n) - irreducible[last])
    return np.maximum(prefix, 0)[order]


def _shard(rows: pa.Table) -> pa.Table:
    """Repeated windows of a shard's contexts, and for dealt anchors the windows that stay, for merging."""
    rows = rows.combine_chunks()
    gram = rows["_gram"].to_numpy()
    several = np.isin(gram, [g for g, n in zip(*np.unique(gram, return_counts=True)) if n > 1]) | (rows["_deals"].to_numpy() > 1)
    rows = rows.filter(pa.array(several)).combine_chunks()
    names = ["_gram", "_x", "_c1", "_c2", "_i", "_n", "_window", "_missing", "_key", "_h1", "_start"]
    if not rows.num_rows:
        return pa.table([pa.array([], t) for t in _FOUND_TYPES], names)
    data, offsets = C.text_bytes(rows["_context"].combine_chunks() if isinstance(rows["_context"], pa.ChunkedArray) else rows["_context"])
    lengths = np.diff(offsets)
    owner = np.repeat(np.arange(rows.num_rows), lengths)
    ends = offsets[1:][owner]
    begins = np.zeros(len(data), bool)
    begins[offsets[:-1]] = True
    symbols = data.astype(np.int64) + 1
    packed = packed_symbols(symbols, ends)
    order = suffix_array(symbols, ends, owner, packed)
    new = common_prefixes(symbols, ends, order, begins, packed) < WIDTH
    group = np.empty(len(data), np.int64)
    group[order] = np.cumsum(new)
    window = np.flatnonzero(np.arange(len(data)) + WIDTH <= ends)
    row = owner[window]
    absent = rows["_missing"].to_numpy(zero_copy_only=False)
    key, text = rows["_key"].to_numpy(), rows["_h1"].to_numpy()
    start = rows["_from"].to_numpy()[row] + window - offsets[row]
    # The earliest of each group of equal windows stays: texts in their order, then places.
    by = np.lexsort((text, key, absent))
    changed = (text[by][1:] != text[by][:-1]) | (key[by][1:] != key[by][:-1]) | (absent[by][1:] != absent[by][:-1])
    number = np.empty(rows.num_rows, np.int64)
    number[by] = np.concatenate([[0], np.cumsum(changed)])
    when = (number[row] << np.int64(34)) | start
    earliest = np.full(int(group.max(initial=0)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(earliest, group[window], when)
    gone = when != earliest[group[window]]
    i = window - offsets[row]
    # Runs of removed windows of a context.
    out = np.flatnonzero(gone)
    head = np.append(True, (np.diff(out) > 1) | (row[out][1:] != row[out][:-1])) if len(out) else np.zeros(0, bool)
    at = np.flatnonzero(head)
    runs = np.diff(np.append(at, len(out)))
    removed = out[at]
    stay = np.flatnonzero(~gone & (rows["_deals"].to_numpy()[row] > 1))
    picked = np.concatenate([removed, stay])
    size = np.concatenate([runs, np.ones(len(stay), np.int64)])
    whole = data.tobytes()
    windows = [None] * len(removed) + [whole[w : w + WIDTH] for w in window[stay]]
    take = pa.array(row[picked])
    columns = [rows[c].take(take) for c in ("_gram", "_x", "_c1", "_c2")]
    columns += [pa.array(i[picked]), pa.array(size), pa.array(windows, pa.binary())]
    columns += [rows[c].take(take) for c in ("_missing", "_key", "_h1")] + [pa.array(start[picked])]
    return pa.table(columns, names)


_FOUND = "_gram bigint, _x int, _c1 bigint, _c2 bigint, _i bigint, _n bigint, _window binary, _missing boolean, _key bigint, _h1 bigint, _start bigint"
_FOUND_TYPES = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary(), pa.bool_(), *[pa.int64()] * 3]


def _merge(rows: pa.Table) -> pa.Table:
    """Windows of a slice that another shard has earlier: lists are merged one after the other by binary search."""
    rows = rows.combine_chunks()
    order = np.lexsort([rows[c].to_numpy(zero_copy_only=False) for c in ("_start", "_h1", "_key", "_missing")])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    shard = rows["_shard"].to_numpy()
    # One more byte, so that zeros at the end count.
    windows = np.array([w + b"\x01" for w in rows["_window"].to_pylist()], dtype=f"S{WIDTH + 1}")
    merged, least = np.zeros(0, windows.dtype), np.zeros(0, np.int64)
    for s in np.unique(shard):
        at = np.flatnonzero(shard == s)
        at = at[np.argsort(windows[at], kind="stable")]
        found = np.searchsorted(merged, windows[at])
        same = np.zeros(len(at), bool)
        inside = found < len(merged)
        same[inside] = merged[found[inside]] == windows[at[inside]]
        np.minimum.at(least, found[same], place[at[same]])
        merged = np.insert(merged, found[~same], windows[at[~same]])
        least = np.insert(least, found[~same], place[at[~same]])
    gone = least[np.searchsorted(merged, windows)] != place
    return rows.select(["_gram", "_x", "_c1", "_c2", "_i", "_n"]).filter(pa.array(gone))


def _cut(batches):
    """Counts and digests of rows from the windows they lose."""
    names = ["_key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for part in C.slices(batches):
        data, offsets = C.text_bytes(part.column("text"))
        copies = part.column("_copy").to_pylist()
        gone = np.zeros(len(data) + 1, np.int64)
        lost = part.column("_lost")
        owner = np.repeat(np.arange(part.num_rows), np.asarray(lost.value_lengths().fill_null(0)))
        flat = lost.flatten()
        if len(flat):
            start = flat.field("start").to_numpy() + offsets[owner]
            np.add.at(gone, start, 1)
            np.add.at(gone, start + flat.field("n").to_numpy() + WIDTH - 1, -1)
        covered = np.cumsum(gone)[:-1] > 0
        for i, copy in enumerate(copies):
            if copy:
                covered[offsets[i] : offsets[i + 1]] = True
        runs, _, before = C.runs(covered, offsets)
        kept = [hashlib.sha256(data[a:b][~covered[a:b]].tobytes()).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [part.column("_key"), pa.array(np.diff(offsets)), pa.array(C.segment_sums(covered.astype(np.int64), offsets)), pa.array(np.diff(before)), pa.array(kept)],
            names,
        )


def lost_windows(docs: DataFrame, key: str, text: str, shard_contexts: int = SHARD_CONTEXTS) -> tuple[DataFrame, DataFrame]:
    """Texts of at least ``WIDTH`` bytes (``_h1``, ``_h2``, ``_first``, ``_rows``), and per text its lost windows (``_h1``, ``_lost``)."""
    named = _named(docs, key, text).filter(F.octet_length("text") >= WIDTH)
    per_key = named.groupBy("_h1", "_h2", "_key").agg(F.count("*").alias("_n"))
    first = F.min(F.struct(F.col("_key").isNull().alias("absent"), F.col("_key").alias("key"), F.col("_n").alias("n")))
    texts = stored(per_key.groupBy("_h1", "_h2").agg(first.alias("_first"), F.sum("_n").alias("_rows")))

    seen = C.map_batches(named.select("_h1", "text"), _candidates, "_gram bigint, _h1 bigint, _at int, _known boolean")
    # Known ones go anywhere; of the others an anchor comes once from each partition at most, however frequent it is.
    dealt = seen.repartition(F.when(F.col("_known"), F.xxhash64("_h1", "_at")).otherwise(F.col("_gram"))).sortWithinPartitions("_known", "_gram")
    places = C.map_batches(dealt, _repeated, "_h1 bigint, _at int").groupBy("_h1").agg(F.collect_set("_at").alias("_places"))

    of_first = places.join(texts.select("_h1", F.col("_first.key").alias("_key1")), "_h1")
    rows = named.select("_key", "_h1", "text").join(of_first, "_h1").filter(F.col("_key").eqNullSafe(F.col("_key1")))
    found = C.map_batches(
        rows.select("_key", "_h1", "text", "_places"), _contexts,
        "_gram bigint, _x int, _context binary, _key bigint, _h1 bigint, _from bigint",
    ).withColumns({"_c1": F.xxhash64("_context"), "_c2": F.xxhash64("_context", F.lit(1)), "_missing": F.col("_key").isNull()})
    contexts = stored(found, compression="zstd")

    same = ["_gram", "_x", "_c1", "_c2"]
    order = F.struct("_missing", "_key", "_h1", "_from")
    # ``_n`` tells whether there is another occurrence at all; the bytes are those of any of them.
    whole = stored(contexts.groupBy(*same).agg(F.min(order).alias("_o"), F.first("_context").alias("_context")))
    different = stored(whole.groupBy("_gram").agg(F.count("*").alias("_n")).filter("_n > 1"))
    n_shards = max(1, -(-(different.agg(F.sum("_n")).first()[0] or 0) // shard_contexts))
    deals = F.ceil(F.col("_n") / shard_contexts).cast("bigint")
    shard = F.pmod(F.xxhash64("_gram", F.when(F.col("_deals") > 1, F.pmod("_c1", F.col("_deals"))).otherwise(0)), F.lit(n_shards))
    sharded = (
        whole.join(different, "_gram").withColumn("_deals", deals).withColumn("_shard", shard)
        .select(*same, "_context", "_o._missing", F.coalesce("_o._key", F.lit(0)).alias("_key"), "_o._h1", "_o._from", "_deals", "_shard")
    )

    def one_shard(key_values, rows):
        found = _shard(rows)
        return found.append_column("_shard", pa.array(np.full(found.num_rows, key_values[0].as_py())))

    results = stored(sharded.groupBy("_shard").applyInArrow(one_shard, f"{_FOUND}, _shard bigint"))
    slices = F.pmod(F.xxhash64("_window"), F.lit(1024))
    merged = (
        results.filter(F.col("_window").isNotNull()).withColumn("_slice", slices).groupBy("_gram", "_slice")
        .applyInArrow(_merge, "_gram bigint, _x int, _c1 bigint, _c2 bigint, _i bigint, _n bigint")
    )
    partial = results.filter(F.col("_window").isNull()).select(*same, "_i", "_n").unionByName(merged)
    of_leader = partial.groupBy(*same).agg(F.collect_list(F.struct("_i", "_n")).alias("_runs"))
    # Stored, so that both sides of the join are plain shuffles and one that holds most rows can be split.
    leaders = stored(whole.select(*same, F.col("_o._h1").alias("_leader"), F.col("_o._from").alias("_at")).join(of_leader, same, "left"))
    is_leader = (F.col("_h1") == F.col("_leader")) & (F.col("_from") == F.col("_at"))
    n_windows = F.octet_length("_context") - (WIDTH - 1)
    every = F.array(F.struct(F.lit(0).cast("bigint").alias("_i"), F.col("_windows").alias("_n")))
    runs = F.when(is_leader, F.col("_runs")).otherwise(every)
    lost = (
        contexts.select(*same, "_h1", "_from", n_windows.cast("bigint").alias("_windows")).join(leaders, same)
        .select("_h1", "_from", F.explode(runs).alias("_run"))
        .groupBy("_h1").agg(F.collect_list(F.struct((F.col("_from") + F.col("_run._i")).alias("start"), F.col("_run._n").alias("n"))).alias("_lost"))
    )
    return texts, lost


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, kept_sha256."""
    texts, lost = lost_windows(docs, key, text, shard_contexts)
    # Only texts that lose something or have several rows need to be known; what led to them is let go before texts are shuffled.
    told = stored(texts.join(lost, "_h1", "left").filter("_rows > 1 or _lost is not null").select("_h1", "_h2", "_first", "_lost"))
    rows = _named(docs, key, text).join(told, ["_h1", "_h2"], "left")
    is_first = F.col("_first").isNull() | F.col("_key").eqNullSafe(F.col("_first.key"))
    several = is_first & F.coalesce(F.col("_first.n") > 1, F.lit(False))
    plain = rows.filter(~several).withColumn("_copy", ~is_first)
    # Equal rows with the first key: one stays and is looked at, whatever their number; the others lose all their bytes.
    one = stored(
        rows.filter(several).groupBy("_h1", "_h2")
        .agg(F.first("_key").alias("_key"), F.first("text").alias("text"), F.first("_lost").alias("_lost"), F.first("_first.n").alias("_times")),
        compression="zstd",
    )
    all_rows = plain.select("_key", "text", "_copy", "_lost").unionByName(one.select("_key", "text", F.lit(False).alias("_copy"), "_lost"))
    digests = C.map_batches(all_rows, _cut, "_key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return digests.unionByName(_copies_of(one)).withColumnRenamed("_key", key)


def _copies_of(one: DataFrame) -> DataFrame:
    """The digests of the ``_times`` - 1 further copies of each row, made in blocks that go to different tasks."""
    size, more = F.octet_length("text").cast("bigint"), F.col("_times") - 1
    blocks = one.select("_h1", "_key", size.alias("n_bytes"), more.alias("_more"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((more - 1) / COPIES_PER_TASK))).alias("_part"))
    here = F.least(F.lit(COPIES_PER_TASK), F.col("_more") - F.col("_part") * COPIES_PER_TASK).cast("int")
    return blocks.repartition("_h1", "_part").select(
        "_key", "n_bytes", F.explode(F.array_repeat(F.lit(1).cast("bigint"), here)).alias("n_spans")
    ).select("_key", "n_bytes", F.col("n_bytes").alias("n_removed"), "n_spans", F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"))
