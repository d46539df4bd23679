"""Benchmark decontamination by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegralType

from tidemark.llm.batches import add_columns

WINDOW = 13
BLOCK = 2
#: Benchmark text whose windows one worker holds at a time; a larger benchmark is searched for part by part.
PART_BYTES = 2 << 20
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    """Words of a text; bytes.lower() lower-cases A-Z alone."""
    return _WORD.findall(text.encode().lower()) if text else []


class WuManber:
    """Windows of similar length. ``shift`` says by the last block of a window's first ``least`` words how far the
    search may go on; blocks that may end those words lead to a bucket, split by first block, of windows to compare."""

    def __init__(self, windows: list[tuple[int, ...]]):
        self.least = min(map(len, windows))
        self.block = min(BLOCK, self.least)
        self.longest_shift = self.least - self.block + 1
        self.shift: dict[tuple[int, ...], int] = {}
        self.bucket: dict[tuple[int, ...], dict[tuple[int, ...], list[int]]] = {}
        self.windows = windows
        for k, window in enumerate(windows):
            for end in range(self.block, self.least + 1):
                block = window[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.longest_shift), self.least - end)
            self.bucket.setdefault(window[self.least - self.block : self.least], {}).setdefault(window[: self.block], []).append(k)

    def search(self, text: tuple[int, ...]):
        """(start, window number) of every occurrence."""
        end, size, least, block = self.least, len(text), self.least, self.block
        shift, far = self.shift.get, self.longest_shift
        while end <= size:
            last = text[end - block : end]
            step = shift(last, far)
            if step:
                end += step
                continue
            start = end - least
            for k in self.bucket[last].get(text[start : start + block], ()):
                window = self.windows[k]
                if text[start : start + len(window)] == window:
                    yield start, k
            end += 1


class Benchmark:
    """The windows of benchmark items: 13 words, or all of a shorter item."""

    def __init__(self, items: list[tuple[str | None, str | None]]):
        self.number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = tuple(self.number.setdefault(w, len(self.number)) for w in words(text))
            for start in range(max(1, len(ids) - WINDOW + 1) if ids else 0):
                owners.setdefault(ids[start : start + WINDOW], set()).update([] if item is None else [item])
        by_length: dict[int, list[tuple[int, ...]]] = {}
        for window in owners:
            by_length.setdefault(len(window).bit_length() if len(window) < WINDOW else WINDOW, []).append(window)
        self.searches = [(s := WuManber(w), [sorted(owners[x]) for x in s.windows]) for w in by_length.values()]

    def find(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs [start, end) of hit words, merged and in order, and the items whose windows occur."""
        number = self.number.get
        ids = tuple([number(w, -1) for w in text])
        runs: list[tuple[int, int]] = []
        items: set[str] = set()
        for search, owners in self.searches:
            for start, k in search.search(ids):
                runs.append((start, start + len(search.windows[k])))
                items.update(owners[k])
        return merged(runs), items


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _parts(benchmark: DataFrame, item_column: str, text_column: str):
    """The benchmark in parts of about ``PART_BYTES``, one after the other on the driver."""
    size = benchmark.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    n = -(-size // PART_BYTES)
    part = F.pmod(F.xxhash64(F.col(item_column).cast("string"), F.col(text_column)), F.lit(n))
    for k in range(n):
        rows = benchmark if n == 1 else benchmark.where(part == k)
        yield [(r[0], r[1]) for r in rows.select(F.col(item_column).cast("string"), text_column).collect()]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Which words of each whole text lie in an occurrence of a benchmark window.

    Returns ``keep`` (the id if not given), ``n_words``, ``hit_runs`` (starts and ends of the runs of hit
    words, alternating), ``hit_items`` (items with occurring windows, sorted as texts; whole numbers where the items
    have such, texts otherwise) and ``n_hit``. There is no shuffle: every task holds the search tables of one part of the benchmark at a time. A null or empty text
    has no words, an item without words has no window; the windows of an item without id mark words but
    name no item; repeated items count once. Repeated rows and null ids stay, empty tables give empty
    results or no hits, other columns are not read.
    """
    context = docs.sparkSession.sparkContext
    keep = keep or [id_column]
    state = {"n_words": "long", "hit_runs": "array<int>", "hit_items": "array<string>"}
    frame, carried = docs, []
    for items in chain(_parts(benchmark, item_column, item_text_column), [[]]):
        if carried and not items:
            break
        table = context.broadcast(Benchmark(items))  # of at most about PART_BYTES of text

        def work(table=table, carried=tuple(carried)):
            known = table.value

            def step(part):
                out = {c: [] for c in state}
                for k, text in enumerate(part[text_column]):
                    found = words(text)
                    runs, hits = known.find(found)
                    if carried:
                        old = part["hit_runs"][k]
                        runs, hits = merged([*runs, *zip(old[::2], old[1::2])]), hits | set(part["hit_items"][k])
                    out["n_words"].append(len(found))
                    out["hit_runs"].append([x for run in runs for x in run])
                    out["hit_items"].append(sorted(hits))
                return out

            return step

        columns = list(dict.fromkeys([*keep, text_column]))
        frame = add_columns(frame, columns, [text_column, *carried], work, state)
        carried = ["hit_runs", "hit_items"]
    item_type = benchmark.schema[item_column].dataType
    if isinstance(item_type, IntegralType):
        frame = frame.withColumn("hit_items", F.col("hit_items").cast(ArrayType(item_type)))
    odd = F.aggregate(F.transform("hit_runs", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x)
    return frame.select(*keep, *state, odd.alias("n_hit"))
