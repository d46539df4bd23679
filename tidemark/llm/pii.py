"""Personal data: fixed forms, and identifiers found by patterns bootstrapped from their contexts."""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import add_columns, emit_rows
from tidemark.operators.enrich import small_enough
from tidemark.shared import new_folder

BASE_KINDS = ("email", "ip", "card", "phone")
#: Identifiers found by context come last.
KINDS = (*BASE_KINDS, "id")
SPANS = "array<struct<kind:string,start:int,end:int>>"

ROUNDS = 3
#: A pattern is trusted at this share of known instances, damped by ``DAMPING`` unknown ones.
TRUST = 0.8
DAMPING = 1.0
LEAST_INSTANCES = 3
#: Least share of the places where the words of a pattern stand that an identifier follows.
LEAST_PRECISION = 0.5
#: Trusted patterns of up to this many bytes are sent to every task; more are joined.
BROADCAST_BYTES = 8 << 20
HELD_COUNTS = 200_000

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can start inside a run of digits only if it could start at the first of them, so only that is tried.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_HINT = re.compile(r"[0-9]|AKIA")

#: Fixed forms of secrets that serve as seeds beside the base kinds: AWS access key ids, long hexadecimal strings.
_SEED = re.compile(r"AKIA[0-9A-Z]{16}|(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{16,}")
_CORE = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9_/+.-]*[A-Za-z0-9])?")
_NAME = re.compile(r"[A-Za-z_]")
_WORD = re.compile(r"[^\W\d_]+")
CORE_CHARS = 4
CORE_DIGITS = 3

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every @ tried in turn: the local part is the run before it, back to the last match. Linear in the text."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text, start - 1):
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            last = match.end()
        at = text.find("@", max(at + 1, last))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The fixed forms, leftmost and not overlapping within a kind, ordered by start and kind."""
    out: list[Span] = [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=order)


def order(span: Span) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


def name_before(text: str, start: int) -> str | None:
    """The name in ``name = "`` before a position: two letters or more."""
    at = start - (start > 0 and text[start - 1] in "\"'")
    at -= at > 0 and text[at - 1] == " "
    if not at or text[at - 1] not in "=:":
        return None
    at -= 1
    at -= at > 0 and text[at - 1] == " "
    first = at
    while first and _NAME.match(text, first - 1):
        first -= 1
    return text[first:at].lower() if at - first >= 2 else None


class Contexts:
    """Lexical patterns before positions of a text, asked for in rising order; the words of a line are found once."""

    def __init__(self, text: str):
        self.text, self.line_end = text, -1
        self.starts, self.ends = array("q"), array("q")  # of the line's words

    def before(self, start: int) -> str | None:
        """The name in ``name = "``, else the last two words of the line that lie before ``start``."""
        name = name_before(self.text, start)
        if name:
            return f"name {name}"
        if start > self.line_end:
            first = self.text.rfind("\n", 0, start) + 1
            self.line_end = self.text.find("\n", start) % (len(self.text) + 1)
            self.starts, self.ends = array("q"), array("q")
            for m in _WORD.finditer(self.text, first, self.line_end):
                self.starts.append(m.start())
                self.ends.append(m.end())
        k = bisect_right(self.ends, start)
        # a word that goes on to the position is cut there
        cut = [self.text[self.starts[k] : start]] if k < len(self.starts) and self.starts[k] < start else []
        last = [self.text[a:b] for a, b in zip(self.starts[max(0, k - 2) : k], self.ends[max(0, k - 2) : k])] + cut
        return "words " + " ".join(w.lower() for w in last[-2:]) if len(last) >= 2 else None


def word_pairs(text: str) -> Iterator[str]:
    """The patterns of all neighbouring words of each line."""
    for line in text.split("\n"):
        found = _WORD.findall(line.lower())
        for a, b in zip(found, found[1:]):
            yield f"words {a} {b}"


def candidates(text: str, base: list[Span]) -> Iterator[tuple[int, int, bool]]:
    """(start, end, seed) of strings that look like identifiers and touch no base span: ``CORE_CHARS`` or more, with digits."""
    starts = sorted((a, b) for _, a, b in base)
    done = 0
    hint = _HINT.search(text)
    while hint:
        a = b = hint.start()
        while a > done and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        done = b
        for m in _CORE.finditer(text, a, b):
            core = m[0]
            if len(core) < CORE_CHARS:
                continue
            seed = bool(_SEED.fullmatch(core))
            if seed or sum(c.isdigit() for c in core) >= CORE_DIGITS:
                k = bisect_left(starts, (m.end(), 0))
                if not any(y > m.start() for _, y in starts[max(0, k - len(KINDS)) : k]):
                    yield m.start(), m.end(), seed
        hint = _HINT.search(text, done)


def pattern_edges(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(pattern, instance, seed, n): how often each identifier, by its hash, stands in each context."""

    def work():
        def step(parts):
            for part in parts:
                out = {"pattern": [], "value": [], "seed": []}
                for text in part[text_column]:
                    if not text or not ("@" in text or _HINT.search(text)):
                        continue
                    base = base_spans(text)
                    spans = [(a, b, True) for _, a, b in base] + list(candidates(text, base))
                    contexts = Contexts(text)
                    for a, b, seed in sorted(spans):
                        pattern = contexts.before(a)
                        if pattern:
                            out["pattern"].append(pattern)
                            out["value"].append(text[a:b])
                            out["seed"].append(seed)
                yield out

        return step

    found = emit_rows(docs, [text_column], work, {"pattern": "string", "value": "string", "seed": "boolean"})
    return found.groupBy("pattern", F.xxhash64("value").alias("instance")).agg(F.max("seed").alias("seed"), F.count("*").alias("n"))


def score_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Patterns with their trust after ``rounds`` of scoring patterns by instances and instances by patterns.

    Both sides of each round are grouped sums. An instance that isn't a seed gets the probability that not
    all trusted patterns it stands in are wrong.
    """
    known = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("trust"))
    patterns = None
    for k in range(rounds):
        patterns = (
            edges.join(known, "instance")
            .groupBy("pattern")
            .agg((F.sum(F.col("n") * F.col("trust")) / (F.sum("n") + F.lit(DAMPING))).alias("score"), F.sum("n").alias("n_all"), F.countDistinct("instance").alias("n_instances"))
        )
        if k < rounds - 1:
            sure = patterns.where((F.col("score") >= TRUST) & (F.col("n_instances") >= LEAST_INSTANCES)).select("pattern", "score")
            known = (
                edges.join(sure, "pattern", "left")
                .groupBy("instance")
                .agg(F.greatest(F.max("seed").cast("double"), 1 - F.exp(F.sum(F.log(1 - F.coalesce("score", F.lit(0.0)))))).alias("trust"))
            )
    return patterns


def pattern_places(docs: DataFrame, patterns: DataFrame, text_column: str = "text") -> DataFrame:
    """(pattern, places): how often the two words of each pattern stand next to each other in a line of any text."""
    shared = _shared(patterns)

    def work():
        wanted = None if shared is None else shared.value

        def step(parts):
            held: Counter = Counter()
            for part in parts:
                for text in part[text_column]:
                    if text:
                        held.update(word_pairs(text) if wanted is None else filter(wanted.__contains__, word_pairs(text)))
                    if len(held) > HELD_COUNTS:
                        yield {"pattern": list(held), "n": list(held.values())}
                        held.clear()
            yield {"pattern": list(held), "n": list(held.values())}

        return step

    found = emit_rows(docs, [text_column], work, {"pattern": "string", "n": "long"})
    counted = found.groupBy("pattern").agg(F.sum("n").alias("places"))
    return counted.join(patterns.select("pattern"), "pattern") if shared is None else counted


def _shared(patterns: DataFrame):
    """The patterns as a broadcast set if their measured size allows it, else None."""
    if not small_enough(patterns.select("pattern"), BROADCAST_BYTES):
        return None
    return patterns.sparkSession.sparkContext.broadcast(frozenset(r[0] for r in patterns.select("pattern").collect()))


def trusted_patterns(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(pattern): those to extract by, whatever their number and share.

    A pattern is trusted if nearly all identifiers in its places are known ones, it has ``LEAST_INSTANCES`` different ones, and
    identifiers follow it often: words that stand before anything, as ``of the`` does, aren't a sign of one.
    """
    spark = docs.sparkSession
    edges = pattern_edges(docs, text_column).checkpoint()
    scored = new_folder(spark, "pii-patterns")
    score_patterns(edges).where((F.col("score") >= TRUST) & (F.col("n_instances") >= LEAST_INSTANCES)).select("pattern", "n_all").write.parquet(scored)
    sure = spark.read.parquet(scored)
    words = sure.where(F.startswith("pattern", F.lit("words ")))
    folder = new_folder(spark, "pii-trusted")
    places = pattern_places(docs, words, text_column)
    precise = words.join(places, "pattern").where(F.col("n_all") >= LEAST_PRECISION * F.greatest("places", "n_all"))
    sure.where(~F.startswith("pattern", F.lit("words "))).select("pattern").unionByName(precise.select("pattern")).write.parquet(folder)
    return spark.read.schema("pattern string").parquet(folder)


def found_spans(text: str | None) -> tuple[list[Span], list[Span], list[tuple[str, int, int]]]:
    """Base spans, identifiers of known forms, and (pattern, start, end) of strings that a trusted pattern would make one."""
    if not text or not ("@" in text or _HINT.search(text)):
        return [], [], []
    base, contexts, sure, open_ = base_spans(text), Contexts(text), [], []
    for a, b, seed in candidates(text, base):
        if seed:
            sure.append(("id", a, b))
        elif pattern := contexts.before(a):
            open_.append((pattern, a, b))
    return base, sure, open_


def all_spans(text: str | None, trusted: frozenset[str]) -> list[Span]:
    base, sure, open_ = found_spans(text)
    more = sure + [("id", a, b) for pattern, a, b in open_ if pattern in trusted]
    return sorted(base + more, key=order) if more else base


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with each run of overlapping spans replaced by the kind of its first one, in angle brackets."""
    if not spans:
        return text
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def find_personal_data(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", keep: list[str] | None = None, patterns: list[str] | None = None) -> DataFrame:
    """Personal data in each whole text: ``spans`` (kind, start, end in code points, by start and kind) and ``redacted``.

    Kinds are ``email``, ``ip``, ``card``, ``phone`` by their fixed forms, and ``id`` for seeds of other known forms and for strings that
    look like identifiers in a trusted context. ``patterns`` are the trusted contexts, bootstrapped from ``docs`` if not given.
    Returns ``keep`` (the id if not given) and the two columns, one row for each input row. A null text has no
    spans and stays null, an empty one stays empty. Repeated rows and null ids stay, an empty table gives an
    empty result, other columns are not read.
    """
    spark = docs.sparkSession
    keep = keep or [id_column]
    trusted = trusted_patterns(docs, text_column) if patterns is None else spark.createDataFrame([(p,) for p in patterns], "pattern string")
    shared = _shared(trusted)

    def redacted(texts, found):
        return {
            "spans": [[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in found],
            "redacted": [redact(t, s) for t, s in zip(texts, found)],
        }

    if shared is not None:

        def work():
            known = shared.value
            return lambda part: redacted(part[text_column], [all_spans(t, known) for t in part[text_column]])

        return add_columns(docs, keep, [text_column], work, {"spans": SPANS, "redacted": "string"})

    def pending():
        def step(part):
            found = [found_spans(t) for t in part[text_column]]
            return {"open": [[{"kind": p, "start": a, "end": b} for p, a, b in open_] for _, _, open_ in found]}

        return step

    def settled():
        def step(part):
            found = []
            for text, more in zip(part[text_column], part["more"]):
                base, sure, _ = found_spans(text)
                found.append(sorted(base + sure + [("id", s["start"], s["end"]) for s in more or []], key=order))
            return redacted(part[text_column], found)

        return step

    # too many patterns to hold: the strings in question are joined with them by pattern, and come back by row
    folder = new_folder(spark, "pii-rows")
    columns = list(dict.fromkeys([*keep, text_column]))
    packed = docs.select(F.struct(*columns).alias("row"), F.col(text_column).alias(text_column), F.monotonically_increasing_id().alias("at"))
    add_columns(packed, ["row", text_column, "at"], [text_column], pending, {"open": SPANS}).write.parquet(folder)
    rows = spark.read.parquet(folder)
    asked = rows.select("at", F.explode("open").alias("s")).select("at", F.col("s.kind").alias("pattern"), F.struct("s.start", "s.end").alias("span"))
    more = asked.join(trusted, "pattern", "left_semi").groupBy("at").agg(F.collect_list("span").alias("more"))
    joined = rows.drop("open").join(more, "at", "left")
    done = add_columns(joined, ["row"], [text_column, "more"], settled, {"spans": SPANS, "redacted": "string"})
    return done.select(*[F.col("row").getField(c).alias(c) for c in keep], "spans", "redacted")
