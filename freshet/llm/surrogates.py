"""Surrogates for personal data, with built-in functions only.

Detected: e-mail addresses, IPv4 addresses, phone numbers, social security numbers, card
numbers, and names after a form of address or with a known given name (``names.py``), and, in
the same document, every bare mention of such a name's surname. A mention is reduced
to its parts (a name's words are parts of their own), each with a type and a normal
form: digits of numbers (a phone number's last ten), lower case otherwise. A part's
surrogate is drawn from ``sha2(key | type | normal form | attempt)``:

* type-consistent: card numbers keep the first digit and their Luhn remainder, IPs stay
  dotted quads, US numbers keep digits 2-9 where they had them, e-mails keep the
  labels' lengths and the top-level domain;
* gender and script: given names come from the lists of the same gender and script (``names.py``; pairs of
  them where the corpus holds most), surnames are made of syllables and a surname's ending of the same script;
* format: the mention's own punctuation, spacing and case carry the surrogate.

Coreference: equal normal forms get one surrogate in all documents, "Mrs. Ada Moss" and
"Ms. Moss" and a bare "Moss" of that document share the surname's. Distinctness: over the distinct parts of the corpus a
surrogate is accepted only if no other part of the type has it and it isn't itself a
part of the corpus; losers draw again (the collision check, one small join an
attempt; names and e-mails grow, so the loop ends). A type whose values the corpus nearly exhausts
(half the attempts failed) settles for surrogates that are distinct, though one may be another entity's real value.

Only parts, mentions and the texts that hold one are shuffled. Documents without
personal data pass through untouched. A mention that a third of all documents share is
one row of the map; the join back leaves splitting to AQE.

Long tokens cost time in proportion: patterns repeat classes or possessive groups, which Java runs as
loops, and a host name has at most 127 labels (its own limit); what follows is no part of an address.

Defined cases: NULL and empty texts stay as they are. Repeated rows give equal rows.
NULL ids are allowed. An empty table gives no rows. ``replaced`` keeps all other columns.
Not found: names with neither a form of address nor a listed given name, one-letter names, bare
given names, surnames in lower case, and a surname that only another document introduces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import ready, release, stored, table, text_key
from freshet.llm.names import KNOWN, KNOWN_CYRILLIC

KEY = "freshet"  # the default key; set spark.freshet.surrogate.key to a secret of your own
ATTEMPTS = 64
ROWS_A_FILE = 20_000  # of mentions and their parts: narrow rows under wide expressions, which every partition compiles anew
SEPARATOR = "\x00"

# fixed values: forms of address and given names by gender, of the scripts covered
TITLES = {
    "m": ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Srta", "госпожа"),
    "n": ("Dr", "Prof"),
}
_FIRST = {
    "m": ("James", "Robert", "Michael", "William", "Richard", "Joseph", "Charles", "Christopher", "Daniel", "Matthew"),
    "f": ("Patricia", "Jennifer", "Elizabeth", "Barbara", "Susan", "Jessica", "Margaret", "Dorothy", "Rebecca", "Catherine"),
    "n": ("Robin", "Jordan", "Taylor", "Morgan", "Casey", "Riley", "Quinn", "Rowan", "Avery", "Sidney"),
}
_FIRST_CYRILLIC = {
    "m": ("Александр", "Дмитрий", "Сергей", "Михаил", "Николай"),
    "f": ("Анастасия", "Екатерина", "Наталья", "Татьяна", "Светлана"),
    "n": ("Женя", "Саша", "Валя", "Слава", "Шура"),
}
# surrogates are drawn from these and all listed names of the gender that no other gender shares
GIVEN = {g: tuple(dict.fromkeys([*_FIRST[g], *KNOWN[g].split()])) for g in "mfn"}
GIVEN_CYRILLIC = {g: tuple(dict.fromkeys([*_FIRST_CYRILLIC[g], *KNOWN_CYRILLIC[g].split()])) for g in "mfn"}
ENDINGS = "son man ton ford well berg ner ley field wood dale more ham lin sen".split()
ENDINGS_CYRILLIC = {"m": "ов ев ин ский".split(), "f": "ова ева ина ская".split()}
SYLLABLES = "ba be bi bo bu da de di do du fa fe ga go ha he ka ke ki ko la le li lo lu ma me mi mo na ne ni no pa pe po ra re ri ro sa se si so ta te ti to va ve vi".split()
SYLLABLES_CYRILLIC = "ба бе би бо ва ве ви га го да де ди до за зе ка ке ко ла ле ли ло ма ме ми мо на не ни но па пе по ра ре ри ро са се со та те ти то".split()

# a name's word: inner capitals, apostrophes and hyphens, all capitals; not the 's of a genitive
_L = r"[\p{L}\p{M}]"
_JOINED = rf"(?:['’-](?![sS](?!{_L})){_L}++)"
_WORD = rf"\p{{Lu}}(?:{_L}++{_JOINED}*+|{_JOINED}++)"
_INITIALS = r"(?:\p{Lu}\. ){0,2}"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){0,126}\.[A-Za-z]{2,}"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IP = r"(?<![\d.])(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?!\.?\d)"
PHONE = (r"(?<![\p{L}\d])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
         r"|(?<![\p{L}\d])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\p{L}\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])")
SSN = r"(?<![\p{L}\d-])\d{3}-\d{2}-\d{4}(?![\p{L}\d-])"
CARD = r"(?<![\p{L}\d])\d(?:[ -]?\d){12,18}(?![\p{L}\d])"
_TITLES = "|".join(t for g in TITLES.values() for t in g)
KNOWN_GIVEN = {g: tuple(sorted({*GIVEN[g], *GIVEN_CYRILLIC[g]})) for g in "mfn"}


def _trie(words) -> str:
    """A pattern of the words, longest first, that shares their beginnings."""
    tails: dict[str, list[str]] = {}
    for w in words:
        if w:
            tails.setdefault(w[0], []).append(w[1:])
    body = "|".join(c + _trie(rest) for c, rest in sorted(tails.items()))
    return f"(?:{body}){'?' if '' in words else ''}" if body else ""


_GIVEN = _trie({x for names in KNOWN_GIVEN.values() for n in names for x in (n, n.upper())})
NAME = (rf"(?<!{_L})(?=[\p{{Lu}}г])(?:(?:{_TITLES})\.? {_INITIALS}{_WORD}(?: {_INITIALS}{_WORD}){{0,2}}"
        rf"|{_GIVEN}(?:-{_WORD})?(?!{_L})(?: (?:{_GIVEN}(?!{_L})|\p{{Lu}}\.)){{0,2}} {_WORD})")
MENTION = f"{EMAIL}|{IP}|{SSN}|{PHONE}|{CARD}|{NAME}"
#: a cheap test that every mention passes
MAYBE = rf"[0-9@]|(?<!{_L})(?=[\p{{Lu}}г])(?:{_TITLES}|{_GIVEN})[. -]"


def _list(values) -> Column:
    return F.split(F.lit("|".join(values)), r"\|")  # folded to a constant array


def mentions(text: Column) -> Column:
    return F.when(text.rlike(MAYBE), F.regexp_extract_all(text, F.lit(MENTION), F.lit(0))).otherwise(F.array().cast("array<string>"))


def gaps_of(text: Column) -> Column:
    """The texts between the mentions. Spark compiles the pattern of a split anew for each row, but a replacement's only once a task:
    a text without SEPARATOR is split at it, put in place of the mentions."""
    marked = F.regexp_replace(text, F.lit(MENTION), F.lit(SEPARATOR))
    return F.when(text.contains(SEPARATOR), F.split(text, MENTION, -1)).otherwise(F.split(marked, SEPARATOR, -1))


def _kind(mention: Column) -> Column:
    whole = lambda p: mention.rlike(f"^(?:{p})$")
    return (F.when(mention.contains("@"), "email").when(whole(IP), "ip").when(whole(SSN), "ssn").when(whole(PHONE), "phone")
            .when(whole(CARD), "card").otherwise("name"))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"[^0-9]", "")


def family(name: Column) -> Column:
    """The normal form of a name's word."""
    return F.translate(F.lower(name), "’", "'")


def parts(seen: DataFrame) -> DataFrame:
    """(mention, place, kind, raw, norm): the parts of each distinct mention; kind 'title' (and an initial) stays as it is."""
    m = F.col("mention")
    words = F.split(m, " ")
    title = F.regexp_replace(F.element_at(words, 1), r"\.$", "")
    titled = title.isin(*[t for g in TITLES.values() for t in g])
    known = lambda w, g: F.lower(F.regexp_extract(w, "^[^-]*", 0)).isin(*[n.lower() for n in KNOWN_GIVEN[g]])
    gender = (F.when(title.isin(*TITLES["m"]), "m").when(title.isin(*TITLES["f"]), "f")
              .when(known(F.element_at(words, 1), "m"), "m").when(known(F.element_at(words, 1), "f"), "f").otherwise("n"))
    named = F.transform(words, lambda w, i: F.struct(
        i.alias("place"), F.when((i == 0) & titled | w.rlike(r"^\p{Lu}\.$"), "title").when(i == F.size(words) - 1, "surname")
        .otherwise(F.concat(F.lit("given_"), gender)).alias("kind"), w.alias("raw"), family(w).alias("norm")))
    norm = (F.when(F.col("type") == "phone", F.substring(_digits(m), -10, 10)).when(F.col("type").isin("ssn", "card"), _digits(m))
            .otherwise(F.lower(m)))
    single = F.array(F.struct(F.lit(0).alias("place"), F.col("type").alias("kind"), m.alias("raw"), norm.alias("norm")))
    return (seen.withColumn("type", _kind(m)).select("mention", F.explode(F.when(F.col("type") == "name", named).otherwise(single)).alias("p"))
            .select("mention", "p.*"))


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of an array of digits."""
    n = F.size(digits)
    return F.aggregate(F.transform(digits, lambda d, i: F.when((n - i) % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))),
                       F.lit(0), lambda a, x: a + x) % 10


def drawn_hash(kind: Column, norm: Column, attempt: int, key: str) -> Column:
    """What ``surrogate`` draws from: a function of key, kind, form and attempt alone."""
    return F.sha2(F.concat_ws("|", F.lit(key), kind, norm, F.lit(str(attempt))), 512)


def surrogate(kind: Column, norm: Column, attempt: int, h: Column) -> Column:
    """The normal form's surrogate of one attempt; ``h``: a column that holds its ``drawn_hash``."""
    draw = lambda i: F.conv(F.substring(h, (i % 42) * 3 + 1, F.lit(3)), 16, 10).cast("int")  # noqa: E731  0..4095
    chars = F.split(norm, "")
    pick = lambda values, n: F.element_at(_list(values), n % len(values) + 1)
    # characters: digits and letters stay what they are, in their script
    letters, cyrillic = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя"
    one = lambda c, i: (F.when(c.rlike("[0-9]"), (draw(i) % 10).cast("string")).when(c.rlike("[Ѐ-ӿ]"), pick(cyrillic, draw(i)))
                        .when(c.rlike(r"\p{L}"), pick(letters, draw(i))).otherwise(c))
    extra = min(max(attempt - 2, 0), 20)
    is_cyrillic = norm.rlike("[Ѐ-ӿ]")
    made = lambda n, at: F.when(is_cyrillic, F.concat(*[pick(SYLLABLES_CYRILLIC, draw(F.lit(at + i))) for i in range(n)])).otherwise(
        F.concat(*[pick(SYLLABLES, draw(F.lit(at + i))) for i in range(n)]))
    woman = norm.rlike("[ая]$")
    ending = (F.when(is_cyrillic & woman, pick(ENDINGS_CYRILLIC["f"], draw(F.lit(29)))).when(is_cyrillic, pick(ENDINGS_CYRILLIC["m"], draw(F.lit(29))))
              .otherwise(pick(ENDINGS, draw(F.lit(29)))))
    surname = F.concat(made(2 + extra, 0), ending)
    top = F.substring_index(norm, ".", -1)
    head = norm.substr(F.lit(1), F.length(norm) - F.length(top))
    mail = F.concat(F.concat(*[pick(SYLLABLES, draw(F.lit(i))) for i in range(extra)]) if extra else F.lit(""), F.array_join(F.transform(F.split(head, ""), one), ""), top)
    ip = F.concat_ws(".", F.lit(1) + draw(F.lit(0)) % 223, draw(F.lit(1)) % 256, draw(F.lit(2)) % 256, F.lit(1) + draw(F.lit(3)) % 254)
    ssn = F.concat(F.format_string("%03d", F.lit(100) + draw(F.lit(0)) % 500), F.format_string("%02d", F.lit(1) + draw(F.lit(1)) % 99),
                   F.format_string("%04d", F.lit(1) + (draw(F.lit(2)) * 4096 + draw(F.lit(3))) % 9999))
    phone = F.array_join(F.transform(chars, lambda c, i: F.when(c.between("2", "9"), F.lit(2) + draw(i) % 8).otherwise(draw(i) % 10).cast("string")), "")
    old = F.transform(chars, lambda c: c.cast("int"))
    body = F.transform(old, lambda c, i: F.when((i == 0) | (i == F.size(old) - 1), F.when(i == 0, c).otherwise(0)).otherwise(draw(i) % 10))
    last = (_luhn(old) - _luhn(body) + 10) % 10  # the final digit counts once in the Luhn sum
    card = F.concat(F.array_join(F.transform(F.slice(body, 1, F.size(body) - 1), lambda c: c.cast("string")), ""), last.cast("string"))
    first = F.lit(None).cast("string")
    for g in "mfn":
        one_of = lambda i, g=g: F.when(is_cyrillic, pick([x.lower() for x in GIVEN_CYRILLIC[g]], draw(F.lit(i)))).otherwise(
            pick([x.lower() for x in GIVEN[g]], draw(F.lit(i))))
        name = one_of(30) if attempt < 4 else F.concat(one_of(30), F.lit("-"), one_of(31))
        first = F.when(kind == f"given_{g}", F.concat(name, made(attempt - 11, 0)) if attempt >= 12 else name).otherwise(first)
    return (F.when(kind == "email", mail).when(kind == "ip", ip).when(kind == "ssn", ssn).when(kind == "phone", phone)
            .when(kind == "card", card).when(kind == "surname", surname).otherwise(first))


def assign(entities: DataFrame, key: str, files: int) -> DataFrame:
    """(kind, norm, sub): distinct surrogates for distinct entities, none of them an entity itself; ``files``: what they are dealt over."""
    entities = stored(entities.coalesce(files), "entities")
    real = entities.select("kind", F.col("norm").alias("sub"))
    done, todo = None, entities
    for attempt in range(ATTEMPTS):
        hashed = todo.withColumn("__h", drawn_hash(F.col("kind"), F.col("norm"), attempt, key))  # once a form, not once a character
        drawn = stored(hashed.withColumn("sub", surrogate(F.col("kind"), F.col("norm"), attempt, F.col("__h"))).drop("__h"), "drawn")
        won = drawn.groupBy("kind", "sub").agg(F.min("norm").alias("norm"))
        if attempt < ATTEMPTS // 2:  # a type whose values the corpus nearly exhausts settles for distinct surrogates
            won = won.join(real, ["kind", "sub"], "left_anti")
        if done is not None:
            won = won.join(done.select("kind", "sub"), ["kind", "sub"], "left_anti")
        won = stored(won.select("kind", "norm", "sub").coalesce(files), "assigned")
        done = won if done is None else done.unionByName(won)
        todo = stored(todo.join(won, ["kind", "norm"], "left_anti").coalesce(files), "collided")
        if todo.isEmpty():
            return done
    raise RuntimeError(f"{ATTEMPTS} draws left entities without a surrogate of their own")


def _cased(raw: Column, sub: Column) -> Column:
    capital = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))
    return (F.when((raw == F.upper(raw)) & (raw != F.lower(raw)), F.upper(sub))
            .when(F.substring(raw, 1, 1) != F.lower(F.substring(raw, 1, 1)), F.array_join(F.transform(F.split(sub, "-"), capital), "-"))
            .otherwise(sub))


def _carried(kind: Column, raw: Column, sub: Column) -> Column:
    """A surrogate in the format of the mention's part: digits in its places, its case."""
    shift = F.length(_digits(raw)) - F.length(sub)  # digits before the normal form's (a country code) stay
    spread = F.aggregate(
        F.split(raw, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("k")),
        lambda a, c: F.when(c.rlike("[0-9]"), F.struct(
            F.concat(a["out"], F.when(a["k"] < shift, c).otherwise(F.substring(sub, a["k"] - shift + 1, F.lit(1)))).alias("out"), (a["k"] + 1).alias("k")))
        .otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["k"].alias("k"))), lambda a: a["out"])
    return F.when(kind == "title", raw).when(kind.isin("phone", "card", "ssn"), spread).otherwise(_cased(raw, sub))


def mention_map(seen: DataFrame, key: str, files: int) -> DataFrame:
    """(mention, surrogate, family: normal form and surrogate of its surname) of the distinct mentions."""
    part = stored(parts(seen.coalesce(files)), "parts")
    entity = assign(part.filter("kind <> 'title'").select("kind", "norm").distinct(), key, files)
    word = _carried(F.col("kind"), F.col("raw"), F.col("sub"))
    return (part.join(entity, ["kind", "norm"], "left").coalesce(files)
            .select("mention", "place", "kind", "norm", "sub", word.alias("word")).groupBy("mention")
            .agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("w"),
                 F.max(F.when(F.col("kind") == "surname", F.struct("norm", "sub"))).alias("family"))
            .select("mention", "family", F.concat_ws(" ", F.transform("w", lambda x: x["word"])).alias("surrogate")))


def replaced(docs: DataFrame, doc: str = "doc_id", text: str = "text", key: str | None = None) -> DataFrame:
    """``docs`` with personal data replaced in ``text``, its other columns kept, and ``n_mentions__`` added."""
    key = key or docs.sparkSession.conf.get("spark.freshet.surrogate.key", KEY)
    found = stored(
        docs.select(F.col(doc).cast("string").alias("d"), text_key(text).alias("row_key"), mentions(F.col(text)).alias("m"))
        .filter(F.size("m") > 0).dropDuplicates(["d", "row_key"]), "mentions")
    flat = found.select("d", "row_key", F.posexplode("m").alias("i", "mention"))
    files = 1 + found.agg(F.coalesce(F.sum(F.size("m")), F.lit(0))).first()[0] // ROWS_A_FILE
    by = stored(mention_map(flat.select("mention").distinct(), key, files), "surrogates")
    names = F.col("__names")
    longest = F.array_sort(F.map_keys(names), lambda a, b: F.length(b) - F.length(a))
    bare = F.concat(F.lit(rf"(?<![\p{{L}}\p{{M}}\p{{N}}])(?=\p{{Lu}})(?iu:"), F.array_join(F.concat(longest, F.transform(F.filter(longest, lambda n: n.contains("'")), lambda n: F.replace(n, F.lit("'"), F.lit("’")))), "|"),
                    F.lit(r")(?![\p{L}\p{M}\p{N}])"))
    subs = stored(flat.join(by, "mention").groupBy("d", "row_key").agg(
        F.array_sort(F.collect_list(F.struct("i", "surrogate"))).alias("s"), F.map_from_entries(F.collect_set("family")).alias("__names"))
        .select(F.col("d").alias("__d"), F.col("row_key").alias("__key"), F.transform("s", lambda x: x["surrogate"]).alias("__s"),
                "__names", F.when(F.size(names) > 0, bare).alias("__bare")), "subs")
    release(docs.sparkSession, found, by)  # and the driver plans the wide patterns below over one join only
    has = F.coalesce(F.col(text).rlike(MAYBE) & F.col(text).rlike(MENTION), F.lit(False))
    n = F.lit(0).cast("long").alias("n_mentions__")

    def joined(gaps: Column, between: Column) -> Column:
        return F.array_join(F.flatten(F.zip_with(gaps, F.concat(between, F.array(F.lit(""))), lambda g, s: F.array(g, s))), "")

    def surnames(gap: Column) -> Column:
        """(text, n): a text between mentions with the bare surnames of its document replaced."""
        seen = F.regexp_extract_all(gap, F.col("__bare"), F.lit(0))
        new = F.transform(seen, lambda w: F.coalesce(_cased(w, F.element_at(names, family(w))), w))
        return F.when(gap.rlike(r"\p{Lu}") & F.col("__bare").isNotNull() & F.coalesce(F.regexp_like(gap, F.col("__bare")), F.lit(False)), F.struct(
            joined(F.split(gap, F.col("__bare"), -1), new).alias("text"), F.size(seen).cast("long").alias("n"))).otherwise(
            F.struct(gap.alias("text"), F.lit(0).cast("long").alias("n")))

    gaps = F.transform(gaps_of(F.col(text)), surnames)
    whole = joined(F.transform(F.col("__gaps"), lambda g: g["text"]), F.col("__s"))
    count = F.size("__s") + F.aggregate("__gaps", F.lit(0).cast("long"), lambda a, g: a + g["n"])
    changed = (docs.filter(has).join(subs, F.col(doc).cast("string").eqNullSafe(F.col("__d")) & (text_key(text) == F.col("__key")))
               .select(*docs.columns, "__s", gaps.alias("__gaps"))
               .select(*[whole.alias(c) if c == text else F.col(c) for c in docs.columns], count.alias("n_mentions__")))
    return docs.filter(~has).select(*docs.columns, n).unionByName(changed)


def replace_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, personal data replaced, ``n_chars`` brought up to date."""
    release(ready(spark))
    out = replaced(docs).drop("n_mentions__")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return replaced(docs).select("doc_id", "text", F.col("n_mentions__").alias("n_mentions"))
