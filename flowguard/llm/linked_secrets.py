"""Secrets in texts, with multipart credentials linked by interval joins.

Strong findings stand alone: *assign* (a secret's name, then ``:`` or ``=``, then a value of 8 and more
characters), *access* (an access id of 16 and more characters beginning with AKIA) and *hex* (32 and
more hexadecimal digits). Each kind is found by itself, leftmost and without overlaps.

Weak candidates are parts of a credential that prove nothing alone: *key* (an assigned value of 4 to 7
characters, or an opaque token of 20 and more characters with small and capital letters and digits),
*identifier* (an assigned user, login, account or client id) and *endpoint* (a URL with its scheme, or an
assigned host). One pass over a text takes strong and weak parts and the blank lines between
paragraphs, which are the scopes. A weak part is reported only when complementary parts stand in its scope
within ``REACH`` characters of it: a key needs an identifier (access ids count), an identifier needs a
secret (strong ones count), an endpoint needs both.

Planned with DataFrame functions only. Matches and the texts between them give lengths; running sums
over a text's matches give positions (code points). The interval join goes over bins of ``REACH``
characters: a bin keeps, per role, the least start and the greatest end of the parts in it, which is
enough to tell whether one meets a window that is at least two bins long. So the join's rows grow with
the length of the texts and never with pairs of parts.

A null or empty text has no findings. Rows are told apart by a row number, so null and repeated
ids and repeated rows are kept, each by itself. An empty table gives an empty table; further columns
are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.llm.common import store

#: Characters between a weak part and the parts that complete it.
REACH = 300
#: Kinds in the order in which findings at one place are listed; the first three are the strong ones.
KINDS = ("assign", "access", "hex", "key", "identifier", "endpoint")
#: Least lengths: value of an assignment, access id, hexadecimal digits, value of a weak assignment, name.
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX, LEAST_WEAK, LEAST_NAME = 8, 16, 32, 4, 3


def either_case(words: str) -> str:
    """A pattern for words in either case of the ASCII letters, whatever the engine folds."""
    return "".join(f"[{c.upper()}{c}]" if "a" <= c <= "z" else c for c in words)


_IS = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = f"({either_case('password|passwd|secret|token|api_?key')}){_IS}([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{32,}"  # the same runs as [0-9a-f]+ of that length
IDENTIFIER = f"({either_case('client_?id|access_?key_?id|user_?name|user|login|account')}){_IS}([A-Za-z0-9@._+-]+)"
URL = r"""[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20"'<>]+"""
HOST = f"({either_case('endpoint|host_?name|host|server')}){_IS}([A-Za-z0-9._:/-]+)"
TOKEN = "[A-Za-z0-9+/_-]{20,}"
BREAK = r"\n[\x20\x09\x0D]*\n"
#: Parts in the order in which one place is tried.
PARTS = "|".join([ASSIGN, ACCESS, IDENTIFIER, URL, HOST, TOKEN])
#: Opaque tokens have all of these.
MIXED = ("[a-z]", "[A-Z]", "[0-9]")

_NONE, _BREAK = "", "break"


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def part_kind(m: Column) -> Column:
    """What a match of the one pass is: a kind, a break, or nothing."""
    value = F.char_length(F.regexp_extract(m, _whole(ASSIGN), 2))
    name = F.char_length(F.regexp_extract(m, _whole(IDENTIFIER), 2))
    mixed = m.rlike(MIXED[0]) & m.rlike(MIXED[1]) & m.rlike(MIXED[2])
    return (
        F.when(F.startswith(m, F.lit("\n")), _BREAK)
        .when(m.rlike(_whole(ASSIGN)), F.when(value >= LEAST_VALUE, "assign").when(value >= LEAST_WEAK, "key").otherwise(_NONE))
        .when(m.rlike(_whole(ACCESS)), F.when(F.char_length(m) >= LEAST_ACCESS, "access").otherwise(_NONE))
        .when(m.rlike(_whole(IDENTIFIER)), F.when(name >= LEAST_NAME, "identifier").otherwise(_NONE))
        .when(m.rlike(_whole(URL)) | m.rlike(_whole(HOST)), "endpoint")
        .when(m.rlike(_whole(HEX)), "hex")
        .when(mixed, "key")
        .otherwise(_NONE)
    )


def _matches(text: Column, pattern: str, kind, gate: str) -> Column:
    """Per match, the characters since the one before, its length and its kind. The text is only cut
    where the gate's pattern occurs at all."""
    step = lambda m, gap: F.struct(F.char_length(gap).alias("gap"), F.char_length(m).alias("n"), kind(m).alias("kind"))
    found = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern), lambda m, gap: F.when(m.isNotNull(), step(m, gap)))
    return F.when(text.rlike(gate), F.filter(found, lambda x: x.isNotNull()))


def scanned(docs: DataFrame) -> DataFrame:
    """Stored matches ``(row, doc_id, of, matches)`` of every row: one array for each strong kind and
    one for the pass over all parts."""
    text = F.col("text")
    strong = lambda least, kind, length: lambda m: F.when(length(m) >= least, kind).otherwise(_NONE)
    arrays = [
        _matches(text, ASSIGN, strong(LEAST_VALUE, "assign", lambda m: F.char_length(F.regexp_extract(m, _whole(ASSIGN), 2))), ASSIGN),
        _matches(text, ACCESS, strong(LEAST_ACCESS, "access", F.char_length), ACCESS),
        _matches(text, HEX, strong(LEAST_HEX, "hex", F.char_length), HEX),
        _matches(text, f"{BREAK}|{PARTS}", part_kind, PARTS),
    ]
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("row", F.monotonically_increasing_id())
    return store(narrow.select("row", "doc_id", *[a.alias(f"m{k}") for k, a in enumerate(arrays)]), "secret-matches")


def placed(matches: DataFrame) -> DataFrame:
    """``(row, pass, kind, start, end, scope)`` of all matches; passes 0 to 2 are the strong kinds, 3
    takes all parts, whose scope is the number of blank lines before them."""

    def one(k: int) -> Column:
        return F.transform(f"m{k}", lambda m, i: F.struct(F.lit(k).alias("pass"), i.alias("i"), m["gap"].alias("gap"), m["n"].alias("n"), m["kind"].alias("kind")))

    every = F.flatten(F.filter(F.array(*[one(k) for k in range(4)]), lambda a: a.isNotNull()))
    rows = matches.select("row", F.explode(every).alias("m")).select("row", "m.*")
    w = Window.partitionBy("row", "pass").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap").cast("long") + F.col("n")).over(w)
    scope = F.sum((F.col("kind") == _BREAK).cast("long")).over(w)
    return rows.withColumn("end", end).withColumn("scope", scope).select("row", "pass", "kind", (F.col("end") - F.col("n")).alias("start"), "end", "scope").where(~F.col("kind").isin(_NONE, _BREAK))


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Weak parts ``(row, kind, start, end)`` whose complements stand within ``reach`` characters in
    their scope."""
    kind = F.col("kind")
    role = F.when(kind.isin("access", "identifier"), "name").when(kind == "endpoint", "place").otherwise("secret")
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(lo / reach), F.floor((hi - 1) / reach)))
    cut = parts.where(role != "place").select("row", "scope", role.alias("role"), "start", "end", bins(F.col("start"), F.col("end")).alias("bin"))
    low, high = F.greatest("start", F.col("bin") * reach), F.least("end", (F.col("bin") + 1) * reach)
    having = cut.groupBy("row", "scope", "bin", "role").agg(F.min(low).alias("lo"), F.max(high).alias("hi"))
    weak = parts.where(kind.isin("key", "identifier", "endpoint")).select("row", "scope", "kind", "start", "end")
    weak = weak.withColumn("from", F.greatest(F.col("start") - reach, F.lit(0))).withColumn("to", F.col("end") + reach)
    asked = weak.withColumn("bin", bins(F.col("from"), F.col("to")))
    met = asked.join(having, ["row", "scope", "bin"]).where("lo < to and hi > from")
    found = met.groupBy("row", "kind", "start", "end").agg(F.max((F.col("role") == "name")).alias("name"), F.max(F.col("role") == "secret").alias("secret"))
    needs = F.when(kind == "key", F.col("name")).when(kind == "identifier", F.col("secret")).otherwise(F.col("name") & F.col("secret"))
    return found.where(needs).select("row", "kind", "start", "end")


def secret_spans(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Findings of every row of ``docs (doc_id, text)``: ``(row, doc_id, spans)``, spans being an array of
    (start, rank of the kind, kind, end) by start, then kind."""
    matches = scanned(docs)
    places = placed(matches)
    strong = places.where("pass < 3").select("row", "kind", "start", "end")
    every = strong.unionByName(linked(places.where("pass = 3"), reach))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    spans = every.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return matches.select("row", "doc_id").join(spans, "row", "left").select("row", "doc_id", F.coalesce("spans", none).alias("spans"))
