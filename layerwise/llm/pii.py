"""Personal data replaced by keyed surrogates, in DataFrame expressions only.

One pattern finds the entities of a text (email, ip, iban, card, ssn, phone, person after a title).  An entity's
normal form (lower case, digits only, ...) is what coreference means: every written form of it gets the
same surrogate, poured back into the written form's punctuation and case.  A surrogate is drawn from
SHA-256(key, type, normal form, attempt) and stays of its type: digits for digits, vowels for vowels and
consonants for consonants of the same script (other letters for any letter of their script), octets for octets, a valid Luhn digit where there was one;
titles and the last letter of each name, which carry gender, stay, as do country codes and top-level domains.

Distinctness is checked over the whole table: where two entities of a type draw one surrogate, or a
surrogate is some real entity of the corpus, all but the first by normal form draw again with the next
attempt, until no collision is left.  From attempt ``WIDEN_AFTER`` on emails and names also get drawn letters in
front, one more every second attempt, so that a free surrogate always exists.  The other kinds keep their fixed
format: what still collides after ``DRAWS`` draws takes the free surrogates of its format in a keyed order, found by
listing as many members of the format's space as are taken or wanted, so a crowded space is used to its last
member and only a full one fails.  Texts without entities are not shuffled.

Defined results: null stays null; an empty text stays empty; repeated rows are treated alike; other columns
of the table pass unchanged whatever their names.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwise.llm.common import materialise, prepare
from layerwise.llm.sharding import BUCKET_ROWS, dense_rank

TITLES = "Mrs|Mr|Miss|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señora|Señor|Sra|Sr|Don|Doña|г-н|г-жа"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = [
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"),
    ("ip", rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z]{4})?(?: ?\d{4}){2,6}(?: ?[A-Z0-9]{1,4}){0,2}(?![A-Za-z0-9])"),
    ("card", r"(?<![0-9A-Za-z])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7})(?![0-9A-Za-z])"),
    ("ssn", r"(?<![0-9-])\d{3}-\d{2}-\d{4}(?![0-9-])"),
    ("phone", r"(?<![0-9+])(?:\+\d{8,15}|(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4})(?![0-9])"),
    ("person", rf"(?<!\p{{L}})(?:{TITLES})\.? \p{{Lu}}\p{{Ll}}+(?:[ -]\p{{Lu}}\p{{Ll}}+){{0,2}}"),
]
KINDS = [k for k, _ in PATTERNS]
PATTERN = "|".join(p for _, p in PATTERNS)
MAYBE = rf"[0-9@]|(?:{TITLES})\.? "
# letter classes of one script each: a letter is replaced inside its class
CLASSES = ["aeiou", "bcdfghjklmnpqrstvwxyz", "áàâäéèêëíîïóôöúûü", "çñß", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αειουω", "βγδζθκλμνξπρστφχψ"]
SCRIPTS = {"Latin": "abcdefghijklmnopqrstuvwxyz", "Cyrillic": "абвгдежзийклмнопрстуфхцчшщыэюя", "Greek": "αβγδεζηθικλμνξοπρστυφχψω",
           "Armenian": "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցփքօֆ", "Georgian": "აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ"}  # Latin letters for any other script
WIDENED = ["email", "person"]
WIDEN_AFTER = 8
DRAWS = 8  # of the kinds of fixed format, before the free surrogates are listed
MOST = 1 << 62  # spaces count up to here
STEP = (1 << 31) - 1  # a prime above every letter class, so multiples of it visit a whole space


def kind_of(written: Column) -> Column:
    out = F.lit("person")
    for kind, pattern in reversed(PATTERNS[:-1]):
        out = F.when(written.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def normal_form(kind: Column, written: Column) -> Column:
    digits = _digits(written)
    return F.when(kind == "email", F.lower(written)) \
        .when(kind == "ip", written) \
        .when(kind == "iban", F.replace(written, F.lit(" "), F.lit(""))) \
        .when(kind == "phone", F.right(digits, F.lit(10))) \
        .when(kind == "person", F.lower(F.regexp_replace(written, rf"^(?:{TITLES})\.? ", ""))) \
        .otherwise(digits)


def _byte(digest: Column, i: Column) -> Column:
    """The i-th pseudo-random byte; long forms chain their position through the cycle of 32 bytes."""
    at = F.pmod(i, F.lit(32)) * 2 + 1
    return (F.conv(F.substring(digest, at, F.lit(2)), 16, 10).cast("int") + F.floor(i / 32).cast("int") * 37)


def _script_letter(char: Column, b: Column) -> Column:
    def pick(letters: str) -> Column:
        return F.substring(F.lit(letters), (F.pmod(b, F.lit(len(letters))) + 1).cast("int"), F.lit(1))
    out = pick(SCRIPTS["Latin"])
    for name, letters in SCRIPTS.items():
        out = F.when(char.rlike(rf"\p{{Is{name}}}"), pick(letters)).otherwise(out)
    return out


def _draw(char: Column, b: Column) -> Column:
    out = F.when(char.rlike(r"\p{L}"), _script_letter(char, b)).otherwise(char)
    for letters in CLASSES:
        out = F.when(F.instr(F.lit(letters), char) > 0, F.substring(F.lit(letters), (F.pmod(b, F.lit(len(letters))) + 1).cast("int"), F.lit(1))).otherwise(out)
        if letters.isascii():
            up = letters.upper()
            out = F.when(F.instr(F.lit(up), char) > 0, F.substring(F.lit(up), (F.pmod(b, F.lit(len(up))) + 1).cast("int"), F.lit(1))).otherwise(out)
    return F.when(char.rlike("[0-9]"), F.pmod(b, F.lit(10)).cast("string")).otherwise(out)


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit stands at an undoubled place."""
    chars = F.split(F.reverse(digits), "")

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = d * 2
        return F.when(F.pmod(i, F.lit(2)) == 1, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(d)
    return F.aggregate(F.transform(F.filter(chars, lambda c: c != ""), worth), F.lit(0), lambda a, x: a + x)


def surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The normal form's replacement at this attempt."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, norm, attempt.cast("string")), 256)
    chars = F.filter(F.split(norm, ""), lambda c: c != "")
    n = F.length(norm)
    # characters before ``head`` and from ``tail`` on stay: scheme digit, country, gender ending, top-level domain
    head = F.when(kind == "card", 1).when(kind == "iban", 2).otherwise(0)
    tail = F.when(kind == "email", n - F.length(F.substring_index(norm, ".", -1)) - 1).otherwise(n)

    def draw(c: Column, i: Column) -> Column:
        ends_name = (kind == "person") & F.substring(norm, i + 2, F.lit(1)).isin("", " ", "-")
        return F.when((i < head) | (i >= tail) | ends_name, c).otherwise(_draw(c, _byte(digest, i)))
    drawn = F.array_join(F.transform(chars, draw), "")
    octets = F.concat_ws(".", *[(F.pmod(_byte(digest, F.lit(i)), F.lit(254)) + 1).cast("string") for i in range(4)])
    body = F.left(drawn, n - 1)
    check = F.pmod(F.lit(10) - F.pmod(_luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    card = F.when(F.pmod(_luhn_sum(norm), F.lit(10)) == 0, F.concat(body, check)).otherwise(drawn)
    more = F.when(kind.isin(WIDENED) & (attempt >= WIDEN_AFTER), F.floor((attempt - WIDEN_AFTER) / 2).cast("int") + 1).otherwise(0)
    second = F.sha2(F.concat_ws("|", F.lit(key), F.lit("more"), kind, norm, attempt.cast("string")), 256)
    script = F.when(kind == "person", F.left(norm, F.lit(1))).otherwise(F.lit("a"))
    extra = F.when(more > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(more, F.lit(1))), lambda i: _script_letter(script, _byte(second, i))), "")).otherwise("")
    return F.when(kind == "ip", octets).when(kind == "card", card).otherwise(F.concat(extra, drawn))


def pour(kind: Column, written: Column, fake: Column) -> Column:
    """The surrogate in the written form: its punctuation, case, title and leading country code."""
    title = F.regexp_extract(written, rf"^(?:{TITLES})\.? ", 0)
    body = F.when(kind == "person", F.right(written, F.length(written) - F.length(title))).otherwise(written)
    significant = F.when(kind.isin("email", "person"), F.lit("(?s).")).when(kind == "iban", F.lit("[A-Z0-9]")).otherwise(F.lit("[0-9]"))
    chars = F.filter(F.split(body, ""), lambda c: c != "")
    marks = F.transform(chars, lambda c: F.regexp_like(c, significant).cast("int"))
    total = F.aggregate(marks, F.lit(0), lambda a, x: a + x)
    longer = F.when(kind.isin(WIDENED), F.greatest(F.length(fake) - total, F.lit(0))).otherwise(0)  # drawn letters in front of the form
    lead = total + longer - F.length(fake)  # significant characters in front that stay

    def put(c: Column, i: Column) -> Column:
        number = F.aggregate(F.slice(marks, 1, i + 1), F.lit(0), lambda a, x: a + x) - lead  # 1-based place in the surrogate
        new = F.substring(fake, number + longer, F.lit(1))
        new = F.when(c != F.lower(c), F.upper(new)).otherwise(new)
        return F.when((F.get(marks, i) == 1) & (number >= 1), new).otherwise(c)
    same_case = F.array_join(F.transform(chars, put), "")
    front = F.left(fake, longer)
    name = F.when(longer > 0, F.concat(F.upper(F.left(front, F.lit(1))), F.substring(front, F.lit(2), longer),
                                       F.lower(F.left(same_case, F.lit(1))), F.substring(same_case, F.lit(2), F.length(same_case)))).otherwise(same_case)
    return F.when(kind == "ip", fake).when(kind == "person", F.concat(title, name)).otherwise(F.concat(front, same_case))


def _count(entities: Column, kind: str) -> Column:
    return F.size(F.filter(entities, lambda x: x["kind"] == kind))


def _class_size(char: Column) -> Column:
    """How many characters ``_draw`` can put in the place of ``char``."""
    size = F.lit(len(SCRIPTS["Latin"]))
    for name, letters in SCRIPTS.items():
        size = F.when(char.rlike(rf"\p{{Is{name}}}"), len(letters)).otherwise(size)
    size = F.when(char.rlike(r"\p{L}"), size).otherwise(1)
    for letters in CLASSES:
        size = F.when(F.instr(F.lit(letters + (letters.upper() if letters.isascii() else "")), char) > 0, len(letters)).otherwise(size)
    return F.when(char.rlike("[0-9]"), 10).otherwise(size)


def _drawn_places(kind: Column, norm: Column) -> tuple[Column, Column]:
    """Places head .. tail of a fixed format that are drawn; a valid card's last digit follows from the others."""
    head = F.when(kind == "card", 1).when(kind == "iban", 2).otherwise(0)
    checked = (kind == "card") & (F.pmod(_luhn_sum(norm), F.lit(10)) == 0)
    return head, F.length(norm) - checked.cast("int")


def _format(kind: Column, norm: Column) -> Column:
    """Name of a format: its fixed characters, and the first of the class for each drawn one."""
    head, tail = _drawn_places(kind, norm)
    chars = F.filter(F.split(norm, ""), lambda c: c != "")
    places = F.transform(chars, lambda c, i: F.when((i < head) | (i >= F.length(norm)), c).otherwise(_draw(c, F.lit(0))))
    return F.when(kind == "ip", F.lit("ip")).otherwise(F.concat(F.array_join(places, ""), F.when(tail < F.length(norm), "*").otherwise("")))


def _space(kind: Column, norm: Column) -> Column:
    """Members of the format's space, up to ``MOST``."""
    head, tail = _drawn_places(kind, norm)
    chars = F.filter(F.split(norm, ""), lambda c: c != "")
    sizes = F.transform(chars, lambda c, i: F.when((i < head) | (i >= tail), 1).otherwise(_class_size(c)).cast("long"))
    most = F.lit(MOST).cast("long")
    total = F.aggregate(sizes, F.lit(1).cast("long"), lambda a, x: F.when(a >= F.floor(most / x), most).otherwise(a * x))
    return F.when(kind == "ip", F.lit(254 ** 4).cast("long")).otherwise(total)


def _member(kind: Column, norm: Column, number: Column) -> Column:
    """The ``number``-th member of the space of ``norm``'s format, its places being digits of a mixed radix."""
    head, tail = _drawn_places(kind, norm)
    chars = F.filter(F.split(norm, ""), lambda c: c != "")
    places = F.reverse(F.transform(chars, lambda c, i: F.struct(c.alias("c"), ((i >= head) & (i < tail)).alias("drawn"))))

    def put(acc: Column, x: Column) -> Column:
        size = F.when(x["drawn"], _class_size(x["c"])).otherwise(1).cast("long")
        char = F.when(x["drawn"], _draw(x["c"], acc["rest"])).otherwise(x["c"])
        return F.struct(F.call_function("div", acc["rest"], size).alias("rest"), F.concat(char, acc["out"]).alias("out"))
    drawn = F.aggregate(places, F.struct(number.alias("rest"), F.lit("").alias("out")), put, lambda acc: acc["out"])
    body = F.left(drawn, F.length(norm) - 1)
    check = F.pmod(F.lit(10) - F.pmod(_luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    octets = F.concat_ws(".", *[(F.pmod(F.floor(number / F.lit(254 ** i)), F.lit(254)) + 1).cast("string") for i in range(4)])
    return F.when(kind == "ip", octets).when(tail < F.length(norm), F.concat(body, check)).otherwise(drawn)


def free_surrogates(spark, lost: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """lost(kind, norm) of fixed formats -> (kind, norm, fake): members of each format's space that are not in taken(kind, fake).

    A format that wants n surrogates lists its first n + t members in a keyed order, t being the taken ones of that kind and
    length, so at least n of them are free unless the space ends before.  Formats of one kind may share members; the
    caller looks for collisions again."""
    kind, norm = F.col("kind"), F.col("norm")
    lost = lost.select("kind", "norm", _format(kind, norm).alias("format"), F.sha2(F.concat_ws("|", F.lit(key), kind, norm), 256).alias("place"))
    lost = materialise(spark, lost, "pii-lost", small=True)
    size = F.when(kind == "ip", 0).otherwise(F.length("fake"))
    used = taken.groupBy("kind", size.alias("size")).agg(F.count(F.lit(1)).alias("t"))
    formats = lost.groupBy("kind", "format").agg(F.count(F.lit(1)).alias("n"), F.min("norm").alias("norm")) \
        .withColumn("size", F.when(kind == "ip", 0).otherwise(F.length("norm"))).join(used, ["kind", "size"], "left") \
        .withColumn("space", _space(kind, norm)).withColumn("listed", F.least("space", F.col("n") + F.coalesce("t", F.lit(0))))
    formats = materialise(spark, formats.select("kind", "format", "norm", "n", "space", "listed"), "pii-formats", small=True)
    # listed in blocks, so that one format's list is not one row's array
    blocks = formats.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("listed") - 1, F.lit(BUCKET_ROWS)))))
    first = F.col("block") * BUCKET_ROWS
    listed = blocks.repartition("kind", "format", "block") \
        .withColumn("i", F.explode(F.sequence(first, F.least(first + BUCKET_ROWS, F.col("listed")) - 1)))
    start = F.conv(F.left(F.sha2(F.concat_ws("|", F.lit(key), kind, F.col("format")), 256), F.lit(15)), 16, 10).cast("decimal(20,0)")
    number = F.pmod(F.col("i").cast("decimal(20,0)") * F.lit(STEP).cast("decimal(10,0)") + start, F.col("space").cast("decimal(20,0)")).cast("long")
    listed = listed.select("kind", "format", "i", _member(kind, norm, number).alias("fake"))
    free = materialise(spark, listed.join(taken, ["kind", "fake"], "left_anti"), "pii-free", small=True)
    buckets = F.call_function("div", F.col("listed"), F.lit(BUCKET_ROWS)) + 1
    sized = formats.select("kind", "format", "listed")
    wants = dense_rank(lost.join(sized, ["kind", "format"]), ["kind", "format"], ["place"], buckets, "at")
    gives = dense_rank(free.join(sized, ["kind", "format"]), ["kind", "format"], ["i"], buckets, "at")
    got = wants.select("kind", "format", "norm", "at").join(gives.select("kind", "format", "at", "fake"), ["kind", "format", "at"], "left")
    got = materialise(spark, got.select("kind", "norm", "fake"), "pii-got", small=True)
    if not got.filter("fake is null").isEmpty():
        raise ValueError("a surrogate space is full: it has fewer free members than entities")
    return got


def assign_surrogates(spark, entities: DataFrame, key: str) -> DataFrame:
    """entities(kind, norm), distinct -> (kind, norm, fake), fake distinct within its kind and never a real entity."""
    current = materialise(spark, entities.select("kind", "norm", F.lit(0).alias("attempt"))
                          .withColumn("fake", surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key)), "pii-map", small=True)
    real = entities.select("kind", F.col("norm").alias("fake"), F.lit(True).alias("is_real"))
    columns = ["kind", "norm", "attempt", "fake"]
    for attempt in itertools.count():
        first = current.groupBy("kind", "fake").agg(F.min("norm").alias("owner"), F.count(F.lit(1)).alias("n"))
        bad = first.join(real, ["kind", "fake"], "left").filter("n > 1 or is_real").select("kind", "fake", "owner", F.coalesce("is_real", F.lit(False)).alias("is_real"))
        bad = materialise(spark, bad, "pii-bad", small=True)
        if bad.isEmpty():
            return current.select("kind", "norm", "fake")
        lost = F.coalesce(F.col("is_real") | (F.col("owner") != F.col("norm")), F.lit(False))
        again = current.join(bad, ["kind", "fake"], "left").withColumn("lost", lost).select(*columns, "lost")
        listed = F.col("lost") & ~F.col("kind").isin(WIDENED) if attempt >= DRAWS else F.lit(False)
        moved = again.withColumn("attempt", F.col("attempt") + F.col("lost").cast("int")).filter(~listed)
        # those that keep theirs are not drawn again: a listed surrogate is no draw
        fake = F.when(F.col("lost"), surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key)).otherwise(F.col("fake"))
        moved = moved.withColumn("fake", fake).select(*columns)
        if attempt >= DRAWS:
            again = materialise(spark, again, "pii-again", small=True)
            taken = again.filter("not lost").select("kind", "fake").unionByName(real.select("kind", "fake")).distinct()
            given = free_surrogates(spark, again.filter(listed).select("kind", "norm"), taken, key)
            moved = again.filter(~listed).withColumn("attempt", F.col("attempt") + F.col("lost").cast("int")).withColumn("fake", fake).select(*columns) \
                .unionByName(given.select("kind", "norm", F.lit(attempt).alias("attempt"), "fake"))
        current = materialise(spark, moved, "pii-map", small=True)


def pseudonymise(docs: DataFrame, key: str = "surrogates-1") -> DataFrame:
    """All rows and columns of ``docs`` with entities in ``text`` replaced, and struct column ``_pii`` of counts."""
    spark = docs.sparkSession
    prepare(spark)
    found = F.when(F.col("_text").rlike(MAYBE), F.regexp_extract_all(F.col("_text"), F.lit(PATTERN), F.lit(0))) \
        .otherwise(F.array().cast("array<string>"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").cast("string").alias("_text")) \
        .withColumn("_found", F.coalesce(found, F.array().cast("array<string>")))
    hits = rows.filter("size(_found) > 0").select("_row", "_found", F.split("_text", PATTERN, -1).alias("_gaps"), F.monotonically_increasing_id().alias("_uid"))
    hits = materialise(spark, hits, "pii-hits")
    written = hits.select("_uid", F.posexplode("_found").alias("at", "written")).withColumn("kind", kind_of(F.col("written"))) \
        .withColumn("norm", normal_form(F.col("kind"), F.col("written")))
    mapping = assign_surrogates(spark, materialise(spark, written.select("kind", "norm").distinct(), "pii-entities", small=True), key)
    poured = written.join(mapping, ["kind", "norm"]).withColumn("new", pour(F.col("kind"), F.col("written"), F.col("fake")))
    per_row = poured.groupBy("_uid").agg(F.sort_array(F.collect_list(F.struct("at", "new", "kind"))).alias("_new"))  # one text's entities
    text = F.concat(F.array_join(F.zip_with(F.slice("_gaps", 1, F.size("_new")), "_new", lambda g, x: F.concat(g, x["new"])), ""),
                    F.element_at("_gaps", -1))

    def shaped(df: DataFrame, text: Column, new: Column) -> DataFrame:
        counts = F.struct(*[_count(new, k).alias(k) for k in KINDS])
        return df.select(*[(text if c == "text" else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns], counts.alias("_pii"))
    none = F.array().cast("array<struct<at:int,new:string,kind:string>>")
    return shaped(hits.join(per_row, "_uid"), text, F.col("_new")).unionByName(
        shaped(rows.filter("size(_found) = 0"), F.col("_text"), none))
