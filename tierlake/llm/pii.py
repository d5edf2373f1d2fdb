"""Surrogates for personal data and secrets, with DataFrame functions only.

Detected mentions are replaced by keyed surrogates of the same type and format:
digits stay digits, letters letters of the same case and script, separators stay;
numbers that pass the Luhn test still do; octets of addresses stay below 256.
What has neither letters nor digits (a masked password) becomes letters.

A person is found behind a form of address.  The entities are the words of the
name, so every later mention of the name or of a part of it in the document, with
or without a title, gets the same surrogate, and equal words do so in all
documents; first names keep the gender of the form of address.

One entity has one surrogate in all its spellings (case; separators of numbers),
two entities never share one, and none equals a value that occurs in the corpus:
candidates that collide are drawn again with the next attempt number.  After
``NARROW`` attempts a format is taken to be full and surrogates grow by a letter or
digit an attempt, so that every entity gets one.

Texts without mentions pass unshuffled.  The mentions of a document are aggregated
with the document, the entities of the corpus by value; an entity with very many
mentions is one row of the entity side and is split on the other side by adaptive
execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.base import let, written

# fixed values: what is looked for, in this order
TITLES_M = r"Mr|Sir|Herrn?|Señor|Sr|Monsieur|г-н"
TITLES_F = r"Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|г-жа"
TITLES_N = r"Dr|Prof|Mx"
FIRST_OF_TITLES = "".join(sorted({t[0] for t in f"{TITLES_M}|{TITLES_F}|{TITLES_N}".split("|")}))
_AFTER_PASSWORD = r"|(?<==)(?<=(?:password|PASSWORD|Password)=)[^\s\"']+"
# a name word: capitalised, parts joined by - or ' start with a capital letter too (so a genitive 's stays outside)
NAME = r"\p{Lu}(?:\p{L}{1,40}|['-]\p{Lu}\p{L}{1,40})(?:['-]\p{Lu}\p{L}{1,40}){0,3}"
# each alternative begins with the characters it can start with, so that most places in a text cost one comparison
TYPES = [
    ("email", r"(?=[A-Za-z0-9])(?<![\w+-])[A-Za-z0-9][\w.+-]{0,63}+@(?:[\w-]{1,63}\.){1,126}[A-Za-z]{2,24}"),
    ("secret", r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])|(?=[gs])(?<![0-9A-Za-z])(?:gh[pousr]_|sk[-_])[0-9A-Za-z]{16,}" + _AFTER_PASSWORD
     + r"|(?=[0-9A-Fa-f])(?<![0-9A-Za-z])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![0-9A-Za-z])"),
    ("ssn", r"(?=[0-9])(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("ip", r"(?=[0-9])(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)"),
    ("ip6", r"(?=[0-9A-Fa-f])(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])"),
    ("card", r"(?=[0-9])(?<!\d)(?:\d{13,19}|\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7})(?!\d)"),
    ("iban", r"(?=[A-Z])(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"),
    ("phone", r"(?=[0-9+(])(?:\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.+-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-]|\.\d))"),
    ("person", rf"(?=[{FIRST_OF_TITLES}])(?<![\p{{L}}])(?:{TITLES_M}|{TITLES_F}|{TITLES_N})\.? {NAME}(?: {NAME})?"),
]
SYLLABLES = "ba be bi bo da de di do fa fe fi ga go ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se si so ta te ti to va ve vi vo za".split()
SYLLABLES_CYRILLIC = "ба бе би бо ва ве ви во га го да де ди до за зе ка ки ко ла ле ли ло ма ме ми мо на не ни но па пе ра ре ри ро са се си со та те ти то фа фе фи".split()


#: Scripts and a run of their letters (of lower case where there is one); other letters become Latin ones.
SCRIPTS = [
    (r"[\u0370-\u03ff]", 0x3B1, 17), (r"\p{IsCyrillic}", 0x430, 32), (r"\p{IsHebrew}", 0x5D0, 27), (r"\p{IsArabic}", 0x628, 19),
    (r"\p{IsDevanagari}", 0x915, 37), (r"\p{IsThai}", 0xE01, 46), (r"\p{IsHiragana}", 0x3042, 80), (r"\p{IsKatakana}", 0x30A2, 80),
    (r"\p{IsHangul}", 0xAC00, 4096), (r"\p{IsHan}", 0x4E00, 4096),
]
#: Attempts in the entity's own format before surrogates grow.
NARROW = 24

PATTERN = "|".join(f"(?:{p})" for _, p in TYPES)
TITLE = rf"^(?:{TITLES_M}|{TITLES_F}|{TITLES_N})\.? "


def _type(mention: Column) -> Column:
    out = F.lit("secret")  # what stands after "password=" may look like anything
    for name, p in reversed(TYPES):
        out = F.when(mention.rlike(f"^(?:{p.replace(_AFTER_PASSWORD, '')})$"), F.lit(name)).otherwise(out)
    return out


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: bool = False) -> DataFrame:
    """``(doc_id, key, pos, mention, type, parts)`` in the order of the text; key is the xxhash64 of the text.

    ``parts`` are the entities of a mention with their gender: the words of a name, else the mention itself.
    ``known``: all texts hold a mention.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("t"))
    rows = rows if known else rows.where(F.col("t").rlike(PATTERN))
    found = rows.select("doc_id", "key", F.posexplode(F.regexp_extract_all("t", F.lit(PATTERN), F.lit(0))).alias("pos", "mention")) \
        .dropDuplicates(["doc_id", "key", "pos"]).withColumn("type", _type(F.col("mention")))
    entity = F.when(F.col("type").isin("phone", "card", "ssn"), F.regexp_replace("mention", r"\D", "")) \
        .when(F.col("type") == "iban", F.lower(F.regexp_replace("mention", " ", ""))).otherwise(F.lower("mention"))
    gender = F.when(F.col("mention").rlike(rf"^(?:{TITLES_M})\.? "), F.lit("m")).when(F.col("mention").rlike(rf"^(?:{TITLES_F})\.? "), F.lit("f")).otherwise(F.lit("n"))
    words = F.split(F.regexp_replace("mention", TITLE, ""), " ")
    # a first name has the gender of the form of address, a family name none
    named = F.transform(words, lambda w, i: F.struct(F.lower(w).alias("entity"), F.when(i < F.size(words) - 1, gender).otherwise("").alias("gender")))
    single = F.array(F.struct(entity.alias("entity"), F.lit("").alias("gender")))
    return found.withColumn("parts", F.when(F.col("type") == "person", named).otherwise(single))


def _digits(h: Column) -> Column:
    return F.translate(h, "abcdef", "035798")


def _letters(h: Column) -> Column:
    return F.translate(h, "0123456789", "ghijklmnop")


def _random(secret: str, seed: Column, n: int) -> Column:
    """n times 64 hexadecimal digits from the key and the seed."""
    return F.concat(*[F.sha2(F.concat_ws("|", F.lit(secret), F.lit(str(k)), seed), 256) for k in range(n)])


def _drawn(r: Column, i: Column, first: int, size: int) -> Column:
    """Letter i from a run of ``size`` letters, by three random hexadecimal digits."""
    at = F.pmod(F.conv(F.substr(r, F.pmod(i * 3, F.lit(509)) + 1, F.lit(3)), 16, 10).cast("int"), F.lit(size))
    return F.substr(F.lit("".join(chr(first + k) for k in range(size))), at + 1, F.lit(1))


def _same_classes(value: Column, h: Column) -> Column:
    """Each letter or digit of the value replaced by one of its class, from the random digits; all of it if it has none."""
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    letter = lambda r, i: F.substr(_letters(r), F.pmod(i, F.lit(512)) + 1, F.lit(1))
    masked = ~value.rlike(r"[\p{L}\p{Nd}]")

    def one(r: Column, c: Column, i: Column) -> Column:
        out = F.when(masked, letter(r, i)).when(c.rlike(r"\p{Nd}"), F.substr(_digits(r), F.pmod(i, F.lit(512)) + 1, F.lit(1))).when(c.rlike("[a-z]"), letter(r, i))
        for pattern, first, size in SCRIPTS:
            out = out.when(c.rlike(rf"\p{{L}}") & c.rlike(pattern), _drawn(r, i, first, size))
        return out.when(c.rlike(r"\p{L}"), letter(r, i)).otherwise(c)

    return let(h, lambda r: F.array_join(F.transform(chars, lambda c, i: one(r, c, i)), ""))


def _luhn(number: Column) -> Column:
    """The Luhn sum of a digit string modulo 10."""
    digits = F.reverse(F.transform(F.filter(F.split(number, ""), lambda c: c != ""), lambda c: c.cast("int")))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d))
    return F.pmod(F.aggregate(doubled, F.lit(0), lambda a, d: a + d), F.lit(10))


def candidate(kind: Column, entity: Column, gender: Column, attempt: int, secret: str) -> Column:
    """The surrogate of an entity at an attempt."""
    h = _random(secret, F.concat_ws("|", kind, entity, F.lit(str(attempt))), 8)
    plain = _same_classes(entity, h)
    # hexadecimal secrets stay hexadecimal, and so do addresses
    hexed = F.when(entity.rlike("^[0-9a-f]*[a-f][0-9a-f]*$"), F.rpad(F.substr(h, F.lit(1), F.least(F.length(entity), F.lit(512))), F.length(entity), "0")).otherwise(plain)
    ip6 = F.array_join(F.transform(F.filter(F.split(entity, ""), lambda c: c != ""), lambda c, i: F.when(c == ":", c).otherwise(F.substr(h, i + 1, F.lit(1)))), "")
    octet = lambda k: F.pmod(F.conv(F.substr(h, F.lit(1 + 4 * k), F.lit(4)), 16, 10).cast("int"), F.lit(256)).cast("string")
    ip = F.concat_ws(".", *[octet(k) for k in range(4)])
    keep = F.concat(F.substr(entity, F.lit(1), F.lit(1)), F.substr(plain, F.lit(2)))
    check = F.concat(F.substr(keep, F.lit(1), F.length(entity) - 1), F.lit("0"))
    card = F.when(_luhn(entity) == 0, F.concat(F.substr(check, F.lit(1), F.length(entity) - 1), F.pmod(10 - _luhn(check), F.lit(10)).cast("string"))).otherwise(keep)
    tail = F.regexp_extract(entity, r"(\.[a-z]+)$", 1)  # the last label of a mail domain stays
    email = F.concat(F.substr(plain, F.lit(1), F.length(entity) - F.length(tail)), tail)
    phone = F.concat(F.substr(entity, F.lit(1), F.lit(1)), F.substr(plain, F.lit(2)))

    def word(names: list[str], m: str, f: str, n: str) -> Column:
        pick = [F.get(F.array(*map(F.lit, names)), F.pmod(F.conv(F.substr(h, F.lit(1 + 4 * k), F.lit(4)), 16, 10).cast("int"), F.lit(len(names)))) for k in range(4)]
        first = F.concat(*pick[:3], F.when(gender == "m", m).when(gender == "f", f).otherwise(n))
        return F.when(gender == "", F.concat(*pick)).otherwise(first)

    name = F.when(entity.rlike(r"^[\p{IsLatin}'-]+$"), word(SYLLABLES, "rd", "na", "el")) \
        .when(entity.rlike(r"^[\p{IsCyrillic}'-]+$"), word(SYLLABLES_CYRILLIC, "н", "на", "ь")).otherwise(plain)
    made = F.when(kind == "ip", ip).when(kind == "ip6", ip6).when(kind == "card", card).when(kind == "email", email).when(kind == "phone", phone) \
        .when(kind == "name", name).when(kind == "secret", hexed).otherwise(plain)
    if attempt < NARROW:
        return made
    more = F.substr(h, F.lit(65), F.lit(min(attempt - NARROW + 1, 64)))
    return F.concat(made, F.when(entity.rlike("[a-z]"), _letters(more)).otherwise(_digits(more)))


def assign(entities: DataFrame, secret: str, most_attempts: int = NARROW + 64) -> DataFrame:
    """``(type, entity, surrogate, widened)``: distinct surrogates, none of them an entity of its type.

    Of entities that draw the same candidate the smallest keeps it; the others draw again.  ``widened`` surrogates
    are longer than their entity: its format has fewer values than the corpus has entities.  The rounds end because
    a grown surrogate has up to 64 random characters more; only draws that keep colliding there would raise.
    """
    n = entities.sparkSession.sparkContext.defaultParallelism
    open_, done = written(entities.select("type", "entity", "gender").repartition(n, "type", "entity"), "entities"), []
    values = open_.select("type", F.col("entity").alias("surrogate"))
    for attempt in range(most_attempts):
        drawn = open_.withColumn("surrogate", candidate(F.col("type"), F.col("entity"), F.col("gender"), attempt, secret))
        taken = values
        for d in done:
            taken = taken.union(d.select("type", "surrogate"))
        free = drawn.join(taken, ["type", "surrogate"], "left_anti")
        won = written(free.groupBy("type", "surrogate").agg(F.min("entity").alias("entity"))
                      .select("type", "entity", "surrogate", F.lit(attempt >= NARROW).alias("widened")), "surrogates")
        done.append(won)
        open_ = written(open_.join(won.select("type", "entity"), ["type", "entity"], "left_anti"), "entities-open")
        if open_.isEmpty():
            break
    else:
        raise RuntimeError("surrogates of 64 random characters more still collide: the key is not random")
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


def _render(mention: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's spelling: its separators, its upper case, its form of address."""
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("i"))

    def step(a: Column, c: Column) -> Column:
        now = F.substr(surrogate, a["i"], F.lit(1))
        return F.when(c.rlike("[0-9A-Za-z]"), F.struct(F.concat(a["s"], F.when(c.rlike("[A-Z]"), F.upper(now)).otherwise(now)).alias("s"), (a["i"] + 1).alias("i"))) \
            .otherwise(F.struct(F.concat(a["s"], c).alias("s"), a["i"].alias("i")))

    spaced = F.aggregate(F.filter(F.split(mention, ""), lambda c: c != ""), start, step)["s"]
    chars = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    # a grown surrogate goes on behind the mention's last letter
    cased = F.array_join(F.zip_with(chars(mention), chars(surrogate), lambda c, s: F.when(c.rlike("[A-Z]"), F.upper(s)).otherwise(s)), "")
    return F.when(kind.isin("ip", "name"), surrogate) \
        .when(kind.isin("phone", "card", "ssn", "iban"), F.concat(spaced, F.substr(surrogate, F.length(F.regexp_replace(mention, "[^0-9A-Za-z]", "")) + 1))) \
        .otherwise(cased)


def _named(mention: Column, surrogates: Column) -> Column:
    """A person: the form of address and the surrogates of the name's words."""
    return F.concat(F.regexp_extract(mention, rf"({TITLE})", 1), F.array_join(F.transform(surrogates, F.initcap), " "))


def _bare(piece: Column, words: Column, pattern: Column) -> Column:
    """Text between mentions with the known names of its document replaced wherever they stand alone."""
    said = F.transform(F.regexp_extract_all(piece, pattern, F.lit(0)), lambda w: F.initcap(F.try_element_at(words, w)))
    return F.array_join(F.zip_with(F.split(piece, pattern, -1), F.concat(said, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")


def replaced(docs: DataFrame, secret: str, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = "n_chars",
             number_col: str | None = None, widened_col: str | None = None) -> DataFrame:
    """``docs`` with surrogates in the text; all columns stay, ``count_col`` (if there) is counted anew, and ``number_col``
    (if given) is a new column with the number of replaced mentions (names that stand alone not counted), ``widened_col``
    one that tells whether a surrogate is longer than its format.

    NULL and empty texts stay as they are.  Identical rows are treated alike; rows without doc_id like any other.  An
    empty table gives an empty result.  Texts of any length are searched whole; no pattern looks at a run of characters
    more than a bounded number of times.  Ties between colliding draws go to the smallest entity.  A new column must not
    have the name of one that ``docs`` has (ValueError).
    """
    new = [c for c in (number_col, widened_col) if c]
    if clash := sorted({*new} & {*docs.columns}):
        raise ValueError(f"docs has columns {clash} already")
    # the texts with mentions are written once: the patterns run over all texts twice, and over those few again
    hit = F.coalesce(F.col(text_col).cast("string"), F.lit("")).rlike(PATTERN)
    hits = written(docs.where(hit), "mentions-texts")
    found = written(mentions(hits, id_col, text_col, known=True), "mentions")
    kind = F.when(F.col("type") == "person", "name").otherwise(F.col("type"))
    each = found.select("doc_id", "key", "pos", kind.alias("type"), F.posexplode("parts").alias("at", "part")).select("doc_id", "key", "pos", "type", "at", "part.*")
    told = F.array_sort(F.filter(F.collect_set("gender"), lambda g: g != ""))
    entities = each.groupBy("type", "entity").agg(told.alias("g")) \
        .select("type", "entity", F.when(F.size("g") == 0, "").when(F.size("g") == 1, F.get("g", F.lit(0))).otherwise("n").alias("gender"))
    known = assign(entities, secret)
    spoken = each.join(known, ["type", "entity"]).groupBy("doc_id", "key", "pos").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "entity", "surrogate"))), lambda x: F.struct(x["entity"], x["surrogate"])).alias("s"), F.max("widened").alias("widened")) \
        .select(F.col("doc_id").alias("d"), F.col("key").alias("k"), F.col("pos").alias("p"), "s", "widened")
    surrogates = F.transform("s", lambda x: x["surrogate"])
    words = F.split(F.regexp_replace("mention", TITLE, ""), " ")
    person = F.col("type") == "person"
    spoken = found.drop("parts").join(spoken, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")) & (F.col("pos") == F.col("p"))) \
        .select("doc_id", "key", "pos", "widened",
                F.when(person, _named(F.col("mention"), surrogates)).otherwise(_render(F.col("mention"), F.col("type"), F.get(surrogates, F.lit(0)))).alias("new"),
                F.when(person, F.arrays_zip(words.alias("word"), surrogates.alias("name"))).alias("names"))
    per_doc = spoken.groupBy("doc_id", "key").agg(
        F.sort_array(F.collect_list(F.struct("pos", "new"))).alias("found"), F.max("widened").alias("widened"),
        F.array_distinct(F.flatten(F.collect_list("names"))).alias("names"))
    per_doc = written(per_doc.select("doc_id", "key", F.col("found.new").alias("news"), "widened", F.map_from_entries("names").alias("names")), "mentions-by-document")
    key = F.xxhash64(F.coalesce(hits[text_col].cast("string"), F.lit("")))
    both = hits.join(per_doc, hits[id_col].cast("long").eqNullSafe(per_doc["doc_id"]) & (key == per_doc["key"]))
    # longer names first, so that no name hides behind its beginning
    alone = F.concat(F.lit(r"(?<![\p{L}])(?:"), F.array_join(F.sort_array(F.map_keys(per_doc["names"]), False), "|"), F.lit(r")(?![\p{L}])"))
    between = F.split(hits[text_col], PATTERN, -1)
    cleared = F.when(F.size(per_doc["names"]) > 0, F.transform(between, lambda p: _bare(p, per_doc["names"], alone))).otherwise(between)
    joined = F.array_join(F.zip_with(cleared, F.concat(per_doc["news"], F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    cols = [joined.alias(c) if c == text_col else F.length(joined).cast(docs.schema[c].dataType).alias(c) if c == count_col else hits[c] for c in docs.columns]
    added = [(number_col, F.size(per_doc["news"]), F.lit(0)), (widened_col, per_doc["widened"], F.lit(False))]
    changed = both.select(*cols, *[v.alias(c) for c, v, _ in added if c])
    rest = docs.where(~hit).select(*docs.columns, *[v.alias(c) for c, _, v in added if c])
    return changed.unionByName(rest)
