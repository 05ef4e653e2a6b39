"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Found and checked: mail addresses, IPv4 addresses, IBANs (check digits), US social security numbers (ranges), dates (the
calendar), phone numbers (length and area code) and payment card numbers (check digit). What does not check out stays, and
hides nothing: every place of a text is looked at, also those inside of something that did not check out.
A value is a vector of places, each with its own number of choices. A Feistel network over the vector's two halves
permutes all values of one format among themselves under a key: equal values get equal pseudonyms in all documents,
different values of one format different ones, and only the key leads back. Separators stay where they are, check digits
are made anew, and a date stays within its hundred years.

Documents are read once and nothing is shuffled. All of it is built-in functions. Null texts are empty. Repeated rows get
the same text. An empty table gives no rows. All columns are passed through but ``text``, the counts of replaced values
(``n_email`` and so on), which are replaced, and ``n_chars``, if there is one, which becomes that of the new text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import whole_text
from clickloom.llm.expressions import let, numbers

#: The key of the permutations, a parameter of every function here; keep a real one secret.
KEY = "clickloom"
ROUNDS = 10

#: A phone number's next digit; written out below, as a look back takes no repeated group.
DIGIT = r"[\x20.()-]{0,3}[0-9]"
#: The patterns of the kinds, tried in this order at each place. Runs are possessive or bounded and start at their first
#: character, so that no text takes more than linear time; groups that repeat without a bound are possessive too, as the
#: regex engine would call itself once for each repeat of any other.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![A-Za-z0-9.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])",
    # Takes what follows in capitals and digits too; new_iban finds the end.
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![A-Za-z0-9.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "date": r"(?<![A-Za-z0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\1[0-9]{4})(?![0-9A-Za-z]|[./-][0-9])",
    # International numbers take up to 15 digits of what follows too; apart() finds the end.
    "phone": (
        r"(?<![A-Za-z0-9+])(?:\+1[\x20.-]?(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}"
        rf"|\+[0-9]{{1,3}}(?:[\x20.-]?(?:\([0-9]{{1,4}}\)|[0-9]{{1,5}})){{2,6}}(?<=\+[0-9]{DIGIT * 7}{f'(?:{DIGIT})?' * 7}\)?)"
        r"|(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4})(?![0-9A-Za-z]|[.-][0-9])"
    ),
    "card": (
        r"(?<![A-Za-z0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})"
        r"(?![A-Za-z0-9])"
    ),
}
ANY = "|".join(p.replace(r"\1", r"\k<mark>").replace("([./])", "(?<mark>[./])") for p in PATTERNS.values())
#: Each place where a value may start, of no width itself, so that one that does not check out takes nothing away.
START = f"(?=({ANY}))"
#: Starts that are worked off before their texts are joined.
STARTS = 256
#: More characters than a phone number has.
PHONE_CHARACTERS = 64
#: Characters of an IBAN by country, where the registry lists one.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: A range of a hundred years starts in each year that ends in these digits.
CENTURY_FROM = 30


def round_numbers(other: Column, sizes: Column, key: Column) -> Column:
    """For each place of one half a number below its size, from the other half and the key."""
    seed = F.concat_ws("|", key, F.array_join(other.cast("array<string>"), ","))

    def digests(seed: Column) -> Column:
        # One digest has the numbers of 16 places.
        rows = F.sequence(F.lit(0), F.floor(F.size(sizes) / 16).cast("int"))
        return F.transform(rows, lambda row: F.sha2(F.concat_ws("|", seed, row), 512))

    def below(digests: Column) -> Column:
        part = lambda at: F.substring(F.get(digests, F.floor(at / 16).cast("int")), (at % 16) * 8 + 1, F.lit(8))
        number = lambda at: F.conv(part(at), 16, 10).cast("bigint")
        return F.transform(sizes, lambda size, at: (number(at) % size).cast("int"))

    return let(let(seed, digests), below)


def shuffled(place: Column, size: Column, key: Column, back: bool = False) -> Column:
    """A permutation of few numbers: their order by a keyed hash. For a single place, which has no halves."""
    rows = F.transform(
        F.sequence(F.lit(0), size - 1), lambda n: F.struct(F.sha2(F.concat_ws("|", key, size, n), 256).alias("h"), n.alias("n"))
    )
    order = F.transform(F.sort_array(rows), lambda row: row["n"])
    return F.when(size > 1, F.array_position(order, place).cast("int") - 1 if back else F.get(order, place)).otherwise(place)


def feistel(places: Column, sizes: Column, key: Column, back: bool = False) -> Column:
    """A permutation of all vectors whose places are below ``sizes``, chosen by the key; ``back`` undoes it."""

    def permute(places: Column) -> Column:
        count = F.size(places)
        middle = F.floor((count + 1) / 2).cast("int")
        left, right = F.slice(places, F.lit(1), middle), F.slice(places, middle + 1, count - middle)
        left_sizes, right_sizes = F.slice(sizes, F.lit(1), middle), F.slice(sizes, middle + 1, count - middle)

        def step(halves: Column, turn: Column) -> Column:
            sign = -1 if back else 1

            def changed(own: Column, own_sizes: Column, other: Column) -> Column:
                added = round_numbers(other, own_sizes, F.concat_ws("|", key, turn, count))
                summed = F.zip_with(own, added, lambda a, b: a + b * sign)
                return F.zip_with(summed, own_sizes, lambda a, size: F.pmod(a, size).cast("int"))

            even = turn % 2 == 0
            return F.struct(
                F.when(even, changed(halves["l"], left_sizes, halves["r"])).otherwise(halves["l"]).alias("l"),
                F.when(even, halves["r"]).otherwise(changed(halves["r"], right_sizes, halves["l"])).alias("r"),
            )

        turns = [F.lit(t) for t in (reversed(range(ROUNDS)) if back else range(ROUNDS))]
        start = F.struct(left.cast("array<int>").alias("l"), right.cast("array<int>").alias("r"))
        mixed = let(F.aggregate(F.array(*turns), start, step), lambda halves: F.concat(halves["l"], halves["r"]))
        alone = shuffled(F.get(places, F.lit(0)).cast("int"), F.get(sizes, F.lit(0)), key, back)
        return F.when(count == 1, F.array(alone)).otherwise(mixed)

    return let(places, permute)


def characters(text: Column) -> Column:
    """A text's characters; none for an empty text."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def digits_of(text: Column) -> Column:
    return F.filter(characters(text), lambda c: c.between("0", "9")).cast("array<int>")


def put_digits(text: Column, digits: Column) -> Column:
    """The text with its digits replaced in order."""

    def put(digits: Column) -> Column:
        each = lambda state, c: F.when(
            c.between("0", "9"),
            F.struct(
                F.concat(state["t"], F.get(digits, state["n"]).cast("string")).alias("t"), (state["n"] + 1).alias("n")
            ),
        ).otherwise(F.struct(F.concat(state["t"], c).alias("t"), state["n"].alias("n")))
        start = F.struct(F.lit("").alias("t"), F.lit(0).alias("n"))
        return F.aggregate(characters(text), start, each, lambda state: state["t"])

    return let(digits, put)


def repeat_size(places: Column, size: int) -> Column:
    return F.transform(places, lambda _: F.lit(size))


def luhn_sum(digits: Column) -> Column:
    """The sum that is a multiple of 10 if the last digit checks the others."""
    count = F.size(digits)

    def value(d: Column, at: Column) -> Column:
        twice = (count - at) % 2 == 0
        return F.when(twice & (d > 4), d * 2 - 9).when(twice, d * 2).otherwise(d)

    return F.aggregate(F.transform(digits, value), F.lit(0), lambda a, b: a + b)


def new_card(text: Column, key: str) -> Column:
    """The first digit stays, the others are permuted, the last checks them; null if the number does not check out."""

    def changed(digits: Column) -> Column:
        inner = F.slice(digits, F.lit(2), F.size(digits) - 2)
        permuted = feistel(inner, repeat_size(inner, 10), F.lit(f"{key}|card"))
        body = F.concat(F.slice(digits, F.lit(1), F.lit(1)), permuted)
        whole = let(
            body,
            lambda b: F.concat(b, F.array(F.pmod(-luhn_sum(F.concat(b, F.array(F.lit(0)))), F.lit(10)).cast("int"))),
        )
        plausible = (luhn_sum(digits) % 10 == 0) & (F.get(digits, F.lit(0)) > 0)
        return F.when(plausible, put_digits(text, whole))

    return let(digits_of(text), changed)


def new_phone(text: Column, key: str) -> Column:
    """Area codes of the North American form keep to it; a leading country code stays, all other digits are permuted."""
    country = F.regexp_extract(text, r"^\+([0-9]{1,3})[\x20.(-]", 1)
    kept = F.when(F.startswith(text, F.lit("+")), F.when(country != "", F.length(country)).otherwise(1)).otherwise(0)

    def changed(digits: Column) -> Column:
        count = F.size(digits)

        def with_kept(kept: Column) -> Column:
            rest = F.slice(digits, kept + 1, count - kept)

            def new(rest: Column) -> Column:
                lows = F.when(F.size(rest) == 10, numbers([2, 0, 0, 2, *[0] * 6])).otherwise(repeat_size(rest, 0))
                american = (F.size(rest) == 10) & (F.get(rest, F.lit(0)) >= 2) & (F.get(rest, F.lit(3)) >= 2)

                def permuted(lows: Column) -> Column:
                    places = F.zip_with(rest, lows, lambda d, low: d - low)
                    sizes = F.transform(lows, lambda low: 10 - low)
                    tag = F.concat_ws("|", F.lit(f"{key}|phone"), F.array_join(lows.cast("array<string>"), ""))
                    return F.zip_with(feistel(places, sizes, tag), lows, lambda d, low: d + low)

                return let(F.when(american, lows).otherwise(repeat_size(rest, 0)), permuted)

            return F.concat(F.slice(digits, F.lit(1), kept), let(rest, new))

        return F.when(count.between(8, 15), put_digits(text, let(kept, with_kept)))

    return let(digits_of(text), changed)


def new_ip(text: Column, key: str) -> Column:
    def changed(parts: Column) -> Column:
        valid = F.forall(parts, lambda p: p <= 255)
        permuted = feistel(parts, repeat_size(parts, 256), F.lit(f"{key}|ip"))
        return F.when(valid, F.array_join(permuted.cast("array<string>"), "."))

    return let(F.split(text, r"\.").cast("array<int>"), changed)


def new_ssn(text: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups from 01, serials from 0001."""

    def changed(parts: Column) -> Column:
        area, group, serial = (F.get(parts, F.lit(n)) for n in range(3))
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        area_place = area - 1 - F.when(area > 666, 1).otherwise(0)
        permuted = feistel(F.array(area_place, group - 1, serial - 1), numbers([898, 99, 9999]), F.lit(f"{key}|ssn"))

        def written(p: Column) -> Column:
            area = F.get(p, F.lit(0)) + 1
            area = area + F.when(area > 665, 1).otherwise(0)
            return F.format_string("%03d-%02d-%04d", area, F.get(p, F.lit(1)) + 1, F.get(p, F.lit(2)) + 1)

        return F.when(valid, let(permuted, written))

    return let(F.split(text, "-").cast("array<int>"), changed)


def new_date(text: Column, key: str) -> Column:
    """Permutes the days of the date's hundred years, of which there are 36,524 = 92 * 397 or 36,525 = 75 * 487."""
    iso = F.substring(text, 5, 1) == "-"
    mark = F.substring(text, 3, 1)
    first, second, year = F.substring(text, 1, 2), F.substring(text, 4, 2), F.substring(text, 7, 4)
    # With slashes the month is first if that is a date; with dots the day is first.
    month_first = F.try_to_date(F.concat_ws("-", year, first, second), "yyyy-MM-dd")
    day_first = F.try_to_date(F.concat_ws("-", year, second, first), "yyyy-MM-dd")
    slashed = F.when((mark == "/") & month_first.isNotNull(), F.lit("MM/dd/yyyy")).when(mark == "/", F.lit("dd/MM/yyyy"))
    order = F.when(iso, F.lit("yyyy-MM-dd")).otherwise(F.coalesce(slashed, F.lit("dd.MM.yyyy")))
    day = F.when(iso, F.try_to_date(text, "yyyy-MM-dd")).when(order == "MM/dd/yyyy", month_first).otherwise(day_first)

    def changed(day: Column) -> Column:
        since = F.year(day) - F.pmod(F.year(day) - CENTURY_FROM, F.lit(100))
        start, end = F.make_date(since, F.lit(1), F.lit(1)), F.make_date(since + 100, F.lit(1), F.lit(1))
        days = F.date_diff(end, start)
        width = F.when(days == 36525, 487).otherwise(397)

        def moved(width: Column) -> Column:
            at = F.date_diff(day, start)
            places = F.array(F.floor(at / width).cast("int"), (at % width).cast("int"))
            sizes = F.array((days / width).cast("int"), width)
            tag = F.concat_ws("|", F.lit(f"{key}|date"), since)
            new = let(feistel(places, sizes, tag), lambda p: F.get(p, F.lit(0)) * width + F.get(p, F.lit(1)))
            new = F.date_add(start, new)
            written = F.when(order == "MM/dd/yyyy", F.date_format(new, "MM/dd/yyyy"))
            written = written.when(order == "dd/MM/yyyy", F.date_format(new, "dd/MM/yyyy"))
            return written.when(iso, F.date_format(new, "yyyy-MM-dd")).otherwise(F.date_format(new, "dd.MM.yyyy"))

        return F.when(F.year(day).between(1000 + CENTURY_FROM, 9000), let(width, moved))

    return let(day, changed)


def places_of(chars: Column) -> tuple[Column, Column]:
    """The place of each digit or letter among its kind, and how many there are of that kind; other characters have one."""
    both = LETTERS + LETTERS.upper()
    place = lambda c: F.when(c.between("0", "9"), F.ascii(c) - ord("0")).otherwise(
        F.when(F.instr(F.lit(both), c) > 0, (F.ascii(F.lower(c)) - ord("a"))).otherwise(0)
    )
    size = lambda c: F.when(c.between("0", "9"), 10).when(F.instr(F.lit(both), c) > 0, 26).otherwise(1)
    return F.transform(chars, place), F.transform(chars, size)


def write_places(chars: Column, places: Column) -> Column:
    """Characters of the same kinds at the given places."""
    small, capital = ([F.lit(c) for c in letters] for letters in (LETTERS, LETTERS.upper()))

    def char(c: Column, p: Column) -> Column:
        return (
            F.when(c.between("0", "9"), p.cast("string"))
            .when(c.between("a", "z"), F.get(F.array(*small), p))
            .when(c.between("A", "Z"), F.get(F.array(*capital), p))
            .otherwise(c)
        )

    return F.array_join(F.zip_with(chars, places, char), "")


def permuted_characters(text: Column, tag: Column) -> Column:
    """Letters and digits permuted, each kind and case staying in its places."""

    def changed(chars: Column) -> Column:
        places, sizes = places_of(chars)
        form = F.array_join(F.transform(sizes, lambda s: s.cast("string")), ",")
        return write_places(chars, feistel(places, sizes, F.concat_ws("|", tag, form)))

    return let(characters(text), changed)


def new_email(text: Column, key: str) -> Column:
    """The name before the @ is permuted; the domain stays."""
    name = F.substring_index(text, "@", 1)
    return F.concat(permuted_characters(name, F.lit(f"{key}|email")), F.substr(text, F.length(name) + 1))


def iban_rest(text: Column) -> Column:
    """The remainder by 97 of a number of digits and capitals, where A is 10."""
    step = lambda rest, c: F.when(
        c.between("0", "9"), (rest * 10 + F.ascii(c) - ord("0")) % 97
    ).otherwise((rest * 100 + F.ascii(c) - ord("A") + 10) % 97)
    return F.aggregate(characters(text), F.lit(0), step)


def iban_in(run: Column) -> Column:
    """The start of a run of groups that checks out, or null: that of the country's length, else the longest one."""
    lengths = F.create_map(*[F.lit(part) for item in IBAN_LENGTHS.items() for part in item])

    def chosen(run: Column) -> Column:
        ends = F.filter(
            F.sequence(F.length(run), F.lit(15), F.lit(-1)), lambda end: F.substr(run, end + 1, F.lit(1)).isin("", " ")
        )
        starts = F.transform(ends, lambda end: F.substr(run, F.lit(1), end))
        plain = lambda start: F.replace(start, F.lit(" "), F.lit(""))
        own = F.try_element_at(lengths, F.substr(run, F.lit(1), F.lit(2)))
        first = F.filter(starts, lambda start: F.length(plain(start)) == own)

        def valid(start: Column) -> Column:
            turned = lambda p: F.concat(F.substr(p, F.lit(5)), F.substring(p, 1, 4))
            return let(plain(start), lambda p: F.length(p).between(15, 34) & (iban_rest(turned(p)) == 1))

        return let(starts, lambda _: F.get(F.filter(F.concat(first, starts), valid), F.lit(0)))

    return F.when(F.length(run) >= 15, let(run, chosen))


def new_iban(text: Column, key: str) -> Column:
    """Country and format stay, the account is permuted, the check digits are made anew."""

    def changed(plain: Column) -> Column:
        country, account = F.substring(plain, 1, 2), F.substr(plain, F.lit(5))
        tag = F.concat_ws("|", F.lit(f"{key}|iban"), country)

        def written(account: Column) -> Column:
            check = 98 - iban_rest(F.concat(account, country, F.lit("00")))
            new = F.concat(country, F.lpad(check.cast("string"), 2, "0"), account)
            return with_spaces(text, new)

        return let(permuted_characters(account, tag), written)

    return F.when(text.isNotNull(), let(F.replace(text, F.lit(" "), F.lit("")), changed))


def with_spaces(form: Column, text: Column) -> Column:
    """The text with spaces where ``form`` has them."""
    each = lambda state, c: F.when(
        c == " ", F.struct(F.concat(state["t"], c).alias("t"), state["n"].alias("n"))
    ).otherwise(
        F.struct(
            F.concat(state["t"], F.substring(text, state["n"], F.lit(1))).alias("t"), (state["n"] + 1).alias("n")
        )
    )
    start = F.struct(F.lit("").alias("t"), F.lit(1).alias("n"))
    return F.aggregate(characters(form), start, each, lambda state: state["t"])


NEW: dict[str, Callable[[Column, str], Column]] = {
    "email": new_email,
    "ip": new_ip,
    "iban": new_iban,
    "ssn": new_ssn,
    "date": new_date,
    "phone": new_phone,
    "card": new_card,
}


def named(kind: str, key: str) -> Callable[[Column], Column]:
    def written(value: Column) -> Column:
        parts = F.length(value).alias("length"), F.lit(kind).alias("kind")
        return let(NEW[kind](value, key), lambda new: F.when(new.isNotNull(), F.struct(new.alias("new"), *parts)))

    return written


def replacement(found: Column, key: str) -> Column:
    """What stands for a match, for how many of its characters, and its kind: the first one whose pattern it has and for
    which it checks out. Null if there is none."""
    tried = []
    for kind, pattern in PATTERNS.items():
        value = iban_in(found) if kind == "iban" else found
        tried.append(F.when(found.rlike(f"^(?:{pattern})$"), let(value, named(kind, key))))
    return F.coalesce(*tried)


def apart(cells: Column, key: str) -> Column:
    """The values of the matches, where an international phone number does not take in what checks out by itself.

    It ends before such a value if it has eight digits by then, and gives way to one that goes on behind it. A card number
    does so by chance now and then, and counts for the latter only next to the country code.
    """
    digits = lambda text: F.length(F.regexp_replace(text, "[^0-9]", ""))

    def later(cell: Column, at: Column) -> Column:
        run = cell["found"]

        def step(held: Column, other: Column) -> Column:
            value = other["value"]
            one = F.struct(
                held["at"].alias("at"),
                digits(F.substr(run, F.lit(1), held["at"])).alias("digits"),
                (held["at"] + value["length"] > F.length(run)).alias("beyond"),
                value["kind"].alias("kind"),
            )
            inside = (held["at"] < F.length(run)) & value["kind"].isNotNull()
            rows = F.when(inside, F.concat(held["inside"], F.array(one))).otherwise(held["inside"])
            return F.struct((held["at"] + F.length(other["piece"])).alias("at"), rows.alias("inside"))

        none = F.array().cast("array<struct<at:int,digits:int,beyond:boolean,kind:string>>")
        start = F.struct(F.length(cell["piece"]).alias("at"), none.alias("inside"))
        near = F.slice(cells, at + 2, F.lit(PHONE_CHARACTERS))
        return F.when(F.length(cell["piece"]) < F.length(run), F.aggregate(near, start, step, lambda held: held["inside"]))

    def settled(cell: Column, inside: Column) -> Column:
        over = F.exists(
            inside, lambda o: o["beyond"] & (o["digits"] < 8) & ((o["kind"] != "card") | (o["digits"] <= 3))
        )
        end = F.get(F.filter(inside, lambda o: o["digits"] >= 8), F.lit(0))["at"]
        short = F.regexp_replace(F.substr(cell["found"], F.lit(1), end), "[^0-9)]+$", "")
        cut = F.when(end.isNotNull(), let(short, named("phone", key)))
        return F.when(~F.coalesce(over, F.lit(False)), F.coalesce(cut, cell["value"]))

    def each(cell: Column, at: Column) -> Column:
        phone = (cell["value"]["kind"] == "phone") & F.startswith(cell["found"], F.lit("+"))
        return F.when(phone, let(later(cell, at), lambda inside: settled(cell, inside))).otherwise(cell["value"])

    return F.transform(cells, each)


def joined(pieces: Column, found: Column, key: str) -> Column:
    """The text of the pieces, each but the first with its value in place of its start, and the kinds of the values used.

    A value that starts inside an earlier one is not used; the earlier one may go on through several pieces.
    """
    none = F.array().cast("array<string>")

    def state(skip: Column, out: Column, kinds: Column) -> Column:
        return F.struct(skip.cast("int").alias("skip"), out.alias("out"), kinds.alias("kinds"))

    def step(held: Column, cell: Column) -> Column:
        value, piece = cell["value"], cell["piece"]
        used = (held["skip"] == 0) & value["kind"].isNotNull()
        gone = F.when(used, value["length"]).otherwise(held["skip"])
        text = F.concat(F.when(used, value["new"]).otherwise(""), F.substr(piece, gone + 1))
        kinds = F.when(used, F.concat(held["kinds"], F.array(value["kind"]))).otherwise(held["kinds"])
        return state(F.greatest(gone - F.length(piece), F.lit(0)), F.concat(held["out"], F.array(text)), kinds)

    def some(cells: Column) -> Callable[[Column, Column], Column]:
        def add(held: Column, first: Column) -> Column:
            part = F.aggregate(F.slice(cells, first, F.lit(STARTS)), state(held["skip"], none, none), step)
            text = lambda p: F.array(F.array_join(p["out"], ""))
            both = lambda p: F.concat(held["kinds"], p["kinds"])
            return let(part, lambda p: state(p["skip"], F.concat(held["out"], text(p)), both(p)))

        return add

    def whole(pieces: Column) -> Column:
        later = F.slice(pieces, F.lit(2), F.size(pieces) - 1)
        values = F.transform(found, lambda match: replacement(match, key))
        cells = F.arrays_zip(later.alias("piece"), found.alias("found"), values.alias("value"))
        settled = let(cells, lambda c: F.arrays_zip(c["piece"].alias("piece"), apart(c, key).alias("value")))
        start = state(F.lit(0), F.slice(pieces, F.lit(1), F.lit(1)), none)
        firsts = F.sequence(F.lit(1), F.size(pieces) - 1, F.lit(STARTS))
        done = let(settled, lambda cells: F.aggregate(firsts, start, some(cells)))
        return let(done, lambda d: F.struct(F.array_join(d["out"], "").alias("text"), d["kinds"].alias("kinds")))

    return let(pieces, whole)


def pseudonymise(documents: DataFrame, key: str = KEY) -> DataFrame:
    """The documents with personal data replaced, and ``n_<kind>``: how many values of each kind were."""
    counts = [f"n_{kind}" for kind in PATTERNS]
    names = [name for name in documents.columns if name not in counts]
    rows = documents.select(*[whole_text().alias("text") if name == "text" else F.col(name) for name in names])
    # A split by places drops an empty first piece, so a line end goes first.
    text = F.concat(F.lit("\n"), F.col("text"))
    # Most texts have neither a digit nor an @, and are only looked through once.
    found = F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(START), F.lit(1)))

    def new(found: Column) -> Column:
        return F.when(F.size(found) > 0, joined(F.split(text, START, -1), found, key))

    replaced = "pseudonyms_replaced"
    held = rows.withColumn(replaced, let(found, new))
    kinds = F.col(replaced)["kinds"]
    changed = F.when(kinds.isNotNull(), F.substr(F.col(replaced)["text"], F.lit(2))).otherwise(F.col("text"))

    def number(kind: str) -> Column:
        return F.coalesce(F.size(F.filter(kinds, lambda k: k == kind)), F.lit(0)).cast("bigint").alias(f"n_{kind}")

    out = [changed.alias("text") if name == "text" else F.col(name) for name in names]
    done = held.select(*out, *map(number, PATTERNS))
    if "n_chars" in names:
        done = done.withColumn("n_chars", F.length("text").cast(rows.schema["n_chars"].dataType))
    return done
