"""Secret scans: three span patterns and a randomness test battery, all in SQL expressions.

Base spans are the leftmost non-overlapping matches of each pattern; a match
whose value is too short is dropped with the characters it took.

The battery looks at every run of 20 or more characters of the usual
encodings.  The encoding is inferred from the characters used, and the run is
tested for what a random string of that alphabet would show: a chi-squared
test of uniformity, a runs test about the middle of the alphabet and a serial
correlation test; the least of the three p-values, corrected for their number,
is the run's p.  Random runs have uniform p, words have p near 0, but the
shorter the run the less the tests can tell.  So false discoveries are
controlled per encoding and length band, over the whole table: the runs with p
above ``CLEAR`` tell how many are random, which gives the share of others among
those accepted at each cut; the lowest cut with a share of at most ``FDR``
holds, and a band where no cut does adds no span.  One extra false discovery is
always counted, so no cut holds with fewer than ``FLOOR`` accepted runs: bands
with fewer are pooled by encoding, and those still below are pooled together.

Null texts are empty; repeated rows get equal spans; an empty table gives no
rows.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import clean, stored

KINDS = ("assign", "access", "hex", "random")  # in this order at equal starts
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # a maximal run, so the least length may stand in the pattern
RUN = r"[A-Za-z0-9+/_=-]{20,}"
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
FDR = 0.05
CLEAR = 0.2  # runs with p above this are taken as random when their number is estimated
FLOOR = 20  # 1 / FDR: no cut can hold with fewer accepted runs
CUTS = (0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5)
BANDS = (24, 32, 48, 64, 128)  # upper ends of the length bands, then the rest

DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
#: (name, pattern of the whole run without padding, alphabet in order); the first that fits holds
ENCODINGS = (
    ("decimal", "^[0-9]+$", DIGITS),
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("hexupper", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("lower", "^[a-z]+$", LOWER),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("lower36", "^[a-z0-9]+$", DIGITS + LOWER),
    ("upper36", "^[A-Z0-9]+$", DIGITS + UPPER),
    ("base64", "^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
    ("mixed", "^.*$", UPPER + LOWER + DIGITS + "+/-_="),
)


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


CHUNK = 64  # list entries that one array grows by


def _fold(items: str, step, emit, kind: str, region: str = "''", finish: str = "ALL") -> str:
    """SQL: the entries that ``emit`` adds while a number goes through the entries ``x`` of the
    list ``items`` by ``step``, from 0.

    ``step`` maps the name of the number to its next value, ``emit`` the names of number
    and array to the grown array.  An array is copied whenever it grows, which costs the
    square of its length: entries go in chunks, and the numbers at which the chunks start
    come first (``t``).  ``region`` is a text ``r`` made once a chunk, ``finish`` goes around
    the result.
    """
    part = f"slice(f, k * {CHUNK} + 1, {CHUNK})"
    many = f"sequence(0, cast(greatest(size(f) - 1, 0) div {CHUNK} as int))"
    starts = f"aggregate({many}, array(0), (a, k) -> concat(a, array(aggregate({part}, a[size(a) - 1], (s, x) -> {step('s')}))))"
    grown = (f"aggregate({part}, named_struct('s', t[k], 'out', cast(array() as array<{kind}>)), "
             f"(a, x) -> named_struct('s', {step('a.s')}, 'out', {emit('a.s', 'a.out')}), a -> a.out)")
    body = finish.replace("ALL", f"flatten(transform({many}, k -> transform(array({region}), r -> {grown})[0]))")
    # lists of one entry: so that the list and the starts are made once
    return f"transform(array({items}), f -> transform(array({starts}), t -> {body})[0])[0]"


def _located(text: str, pattern: str, keep: str, entry: str, kind: str) -> Column:
    """Array of spans of the matches that ``keep`` accepts; ``entry`` builds one from
    its begin BEGIN and the match ``x.hit`` (``x.val``: its last group)."""
    regex, group = _quoted(pattern), 2 if pattern == ASSIGN else 0
    found = (f"transform(arrays_zip(split({text}, {regex}, -1), regexp_extract_all({text}, {regex}, 0), "
             f"regexp_extract_all({text}, {regex}, {group})), z -> named_struct('piece', z.`0`, 'hit', z.`1`, 'val', z.`2`))")

    # pieces and matches alternate: a match begins after all pieces and matches before it
    def step(at):
        return f"{at} + length(x.piece) + coalesce(length(x.hit), 0)"

    def emit(at, out):
        return f"if(x.hit is not null and {keep}, concat({out}, array({entry.replace('BEGIN', f'({at} + length(x.piece))')})), {out})"

    return F.expr(f"if({text} rlike {regex}, {_fold(found, step, emit, kind)}, cast(array() as array<{kind}>))")


SPAN = "struct<start:int,kind:int,end:int>"


def _span(kind: int) -> str:
    return f"named_struct('start', BEGIN, 'kind', {kind}, 'end', BEGIN + length(x.hit))"


def _normal(z: str) -> str:
    """Two-sided p of a standard normal value (logistic approximation of its distribution)."""
    return f"least(1D, 2D / (1D + exp(1.5976D * abs({z}) + 0.07056D * pow(abs({z}), 3))))"


def _tested(runs: Column | str) -> str:
    """SQL: array of (start, end, stratum, p) from the array ``runs`` of (start, end, body)."""
    pick = " ".join(f"when r.body rlike '{rule}' then {i}" for i, (_, rule, _) in enumerate(ENCODINGS))
    letters = "array(" + ", ".join(f"'{a}'" for _, _, a in ENCODINGS) + ")"
    band = "case " + " ".join(f"when length(r.body) <= {b} then {i}" for i, b in enumerate(BANDS)) + f" else {len(BANDS)} end"
    named = f"transform({runs}, r -> named_struct('start', r.start, 'end', r.end, 'body', r.body, 'enc', case {pick} end, 'band', {band}))"
    coded = (f"transform({named}, r -> named_struct('start', r.start, 'end', r.end, 'enc', r.enc, 'band', r.band, "
             f"'a', cast(length({letters}[r.enc]) as double), 'n', cast(length(r.body) as double), "
             f"'codes', transform(regexp_extract_all(r.body, '.', 0), ch -> instr({letters}[r.enc], ch) - 1)))")
    squares = ("aggregate(array_sort(r.codes), named_struct('prev', -9, 'run', 0L, 'sum', 0L), (s, v) -> "
               "if(v = s.prev, named_struct('prev', v, 'run', s.run + 1L, 'sum', s.sum + 2L * s.run + 1L), "
               "named_struct('prev', v, 'run', 1L, 'sum', s.sum + 1L)), s -> cast(s.sum as double))")
    walk = ("aggregate(r.codes, named_struct('prev', cast(null as int), 'runs', 0L, 'ones', 0L, 'prod', 0D), (s, v) -> named_struct("
            "'prev', v, 'runs', s.runs + if(s.prev is null or (s.prev * 2 >= r.a) <> (v * 2 >= r.a), 1L, 0L), "
            "'ones', s.ones + if(v * 2 >= r.a, 1L, 0L), "
            "'prod', s.prod + if(s.prev is null, 0D, (s.prev - (r.a - 1D) / 2D) * (v - (r.a - 1D) / 2D))))")
    stats = (f"transform({coded}, r -> named_struct('start', r.start, 'end', r.end, 'enc', r.enc, 'band', r.band, 'a', r.a, 'n', r.n, "
             f"'x', {squares} * r.a / r.n - r.n, 'w', {walk}))")
    # cube-root normal value of chi-squared; runs about the middle; lag-1 correlation with known mean and variance
    chi = "(pow(greatest(r.x, 0D) / (r.a - 1D), 1D / 3D) - (1D - 2D / (9D * (r.a - 1D)))) / sqrt(2D / (9D * (r.a - 1D)))"
    q = "(2D * r.w.ones * (r.n - r.w.ones))"
    runs_z = (f"if({q} <= r.n, 9D, (r.w.runs - 1D - {q} / r.n) / sqrt({q} * ({q} - r.n) / (r.n * r.n * (r.n - 1D))))")
    serial = "r.w.prod / ((r.a * r.a - 1D) / 12D) / sqrt(r.n - 1D)"
    least = f"least({_normal(chi)}, {_normal(runs_z)}, {_normal(serial)})"
    return (f"transform({stats}, r -> named_struct('start', r.start, 'end', r.end, 'stratum', r.enc * 10 + r.band, "
            f"'p', 1D - pow(1D - {least}, 3)))")


def _scanned(docs: DataFrame, text: str) -> DataFrame:
    """Documents plus base spans and tested runs."""
    body = f"coalesce(`{text}`, '')"
    run = "struct<start:int,end:int,body:string>"
    base = F.concat(
        _located(body, ASSIGN, f"length(x.val) >= {ASSIGN_LEAST}", _span(0), SPAN),
        _located(body, ACCESS, f"length(x.hit) >= {ACCESS_LEAST}", _span(1), SPAN),
        _located(body, HEX, "true", _span(2), SPAN))
    entry = "named_struct('start', BEGIN, 'end', BEGIN + length(x.hit), 'body', rtrim('=', x.hit))"
    runs = _located(body, RUN, "length(rtrim('=', x.hit)) >= 20", entry, run)
    out = docs.drop("_base", "_runs").withColumns({"_base": F.array_sort(base), "_runs": runs})
    return out.withColumn("_runs", F.expr(_tested("_runs")))


def _cuts(scanned: DataFrame) -> dict[int, float]:
    """Lowest accepted cut of each stratum (at most encodings x bands rows)."""
    runs = scanned.select(F.explode("_runs").alias("r")).select("r.stratum", "r.p")
    above = [F.sum((F.col("p") >= c).cast("long")).alias(f"c{i}") for i, c in enumerate(CUTS)]
    rows = runs.groupBy("stratum").agg(F.count(F.lit(1)).alias("m"), F.sum((F.col("p") > CLEAR).cast("long")).alias("clear"), *above)
    found, small = {}, []
    for row in rows.collect():
        counts = [row["m"], row["clear"], *(row[f"c{i}"] for i in range(len(CUTS)))]
        if counts[2] < FLOOR:
            small.append((row["stratum"], counts))
        else:
            _settle(found, [(row["stratum"], counts)])
    # too few for a verdict of their own: pooled by encoding, then all that are left
    rest = []
    for encoding in sorted({stratum // 10 for stratum, _ in small}):
        pool = [x for x in small if x[0] // 10 == encoding]
        if sum(counts[2] for _, counts in pool) < FLOOR:
            rest += pool
        else:
            _settle(found, pool)
    _settle(found, rest)
    return found


def _settle(found: dict[int, float], pool: list[tuple[int, list]]) -> None:
    """Give the strata of ``pool`` the lowest cut that holds for all their runs together."""
    m, clear, *above = (sum(column) for column in zip(*(counts for _, counts in pool))) if pool else (0, 0)
    random = min(m, clear / (1 - CLEAR))
    for cut, accepted in zip(CUTS, above):
        if accepted and (max(0.0, accepted - random * (1 - cut)) + 1) / accepted <= FDR:
            found.update({stratum: cut for stratum, _ in pool})
            return


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents plus base_spans and secret_spans: arrays of (start, kind, end), sorted."""
    scanned = stored(_scanned(docs, text), "secrets")
    cuts = _cuts(scanned)
    accepted = ("cast(array() as array<struct<start:int,kind:int,end:int>>)" if not cuts else
                "transform(filter(_runs, r -> r.p >= coalesce(map(" + ", ".join(f"{k}, {v}D" for k, v in sorted(cuts.items()))
                + ")[r.stratum], 2D)), r -> named_struct('start', r.start, 'kind', 3, 'end', r.end))")
    return (scanned.drop("base_spans", "secret_spans").withColumnRenamed("_base", "base_spans")
            .withColumn("secret_spans", F.array_sort(F.concat("base_spans", F.expr(accepted)))).drop("_runs"))


def named(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, s -> concat({names}[s.kind], ':', s.start, ':', s.end)), ',')")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Documents with every secret span replaced by ``mark`` (overlapping spans by one)."""
    body = f"coalesce(`{text}`, '')"
    # what a chunk of spans keeps lies between the ends before and after it
    cut = _fold("secret_spans", lambda at: f"greatest({at}, x.end)", lambda at, out:
                f"if(x.start >= {at}, concat({out}, array(substring(r, {at} - t[k] + 1, x.start - {at}), '{mark}')), {out})", "string",
                f"substring({body}, t[k] + 1, t[k + 1] - t[k])", f"concat(array_join(ALL, ''), substring({body}, t[size(t) - 1] + 1))")
    found = scan(docs, text)
    return found.withColumn(text, F.when(F.size("secret_spans") > 0, F.expr(cut)).otherwise(F.col(f"`{text}`")))


def report(docs: DataFrame) -> DataFrame:
    found = scan(_scan_input(docs))
    count = [F.expr(f"cast(size(filter(base_spans, s -> s.kind = {i})) as bigint)").alias(f"n_{KINDS[i]}") for i in range(3)]
    return found.select("doc_id", *count, F.sha2(named("base_spans"), 256).alias("base_sha256"),
                        named("secret_spans").alias("spans"))


def _scan_input(docs: DataFrame) -> DataFrame:
    return clean(docs, "doc_id", "text")
