"""URL cleaning, splitting and lexical features: native columns, with letters counted in Arrow batches.

Patterns are Java's; classes that must take in all of Unicode carry (?U)."""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

UNKNOWN = "unknown.invalid"
# fixed values: the url pattern, suffix sets and content patterns of the scoring models
URL = r"^(?:[a-z]+:)?//([^/?#:]+)([^?#]*)(?:\?([^#]*))?.*$"
BEGINNING = r"^(?:[a-z]+:)?//[^/?#:]"
SUSPICIOUS_TLDS = ("tk", "ml", "ga", "cf", "gq", "ru", "cn", "cc", "info", "biz", "xyz", "top")
TRUSTWORTHY_TLDS = ("gov", "edu", "mil")
SHORTENER = r"\b(bit\.ly|tinyurl|goo\.gl|t\.co|short\.link|ow\.ly)\b"
CONTENT = {
    "contains_download": r"\b(download|exe|zip|rar|torrent|crack|keygen|apk)\b",
    "contains_phishing": r"\b(login|signin|account|verify|suspended|update|confirm|secure|password)\b",
    "contains_financial": r"\b(bank|paypal|amazon|ebay|visa|mastercard|credit|card|payment)\b",
    "contains_urgency": r"\b(urgent|immediate|expire|limited|act now|hurry|last chance)\b",
    "is_media_or_api": r"\b(api|json|xml|v[1-9]/|/media/)\b",
    "path_contains_sensitive": r"/(login|admin|credentials|wp-admin|config|backup)\b",
}
# fixed values: the trained model's inputs in their order
MODEL_INPUTS = [
    "len_url", "len_path", "len_query", "len_domain", "is_very_short_url", "is_very_long_url", "is_suspicious_tld", "is_trustworthy_tld", "has_ip_address",
    "num_subdomains", "has_excessive_subdomains", "num_path_dirs", "is_root_path", "num_params", "has_excessive_params", "num_digits_domain", "digit_ratio_domain",
    "domain_is_numeric_heavy", "num_hyphens_domain", "domain_hyphen_heavy", "has_suspicious_chars_path", "has_excessive_encoding", "path_keyword_stuffing",
    "contains_download", "contains_phishing", "contains_financial", "contains_urgency", "is_media_or_api", "path_contains_sensitive", "domain_entropy", "path_entropy",
    "vowel_consonant_ratio", "is_ugc_path", "path_has_article_slug", "path_has_date", "path_is_descriptive", "is_quality_article", "is_nsfw_content", "is_spam_content",
    "is_nsfw_domain", "is_quality_domain", "is_news_domain",
]
DIGITS = "0123456789"
IP = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"


def clean(url: Column) -> Column:
    """Without a trailing `"" target=...` and surrounding quotes; null stays null."""
    return F.btrim(F.when(url.contains('""'), F.regexp_replace(url, r'""\s*target=.*$', "")).otherwise(url), F.lit('"'))


def _full(url: Column) -> Column:
    return F.when(url.contains("://"), url).otherwise(F.concat(F.lit("//"), url))


def host(url: Column) -> Column:
    """The domain of a url: lower case, UNKNOWN if there is none."""
    found = F.lower(F.regexp_extract(_full(url), URL, 1))
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(UNKNOWN))


def split(rows: DataFrame) -> DataFrame:
    """Adds domain (as host), path and query to rows with url: the groups of URL, cut at its marks without the pattern's search. Only
    a fragment can keep the pattern from matching once it has begun, by its line ends; such urls are tried with the whole pattern."""
    full, front, head, rest, name = (F.col(c) for c in ("_full", "_front", "_head", "_rest", "_name"))
    matches = F.when(full.contains("#"), full.rlike(URL)).otherwise(full.rlike(BEGINNING))
    rows = rows.withColumn("_full", _full(F.col("url"))).withColumn("_front", F.when(matches, F.substring_index(full, "#", 1)))
    rows = rows.withColumn("_head", F.substring_index(front, "?", 1)).withColumn("_rest", F.substr(head, F.instr(head, "//") + 2))
    rows = rows.withColumn("_name", F.substring_index(F.substring_index(rest, "/", 1), ":", 1))
    path, query = F.substr(rest, F.length(name) + 1), F.when(front.contains("?"), F.substr(front, F.length(head) + 2))
    added = {"domain": F.coalesce(F.lower(name), F.lit(UNKNOWN)), "path": F.coalesce(path, F.lit("")), "query": F.coalesce(query, F.lit(""))}
    return rows.withColumns(added).drop("_full", "_front", "_head", "_rest", "_name")


def tld(host: Column) -> Column:
    return F.when(host.contains("."), F.substring_index(host, ".", -1)).otherwise("")


#: n log n of small numbers, and the characters that are counted beside the entropy: letters of hosts, marks of paths, of which the
#: last are those of ASCII that are odd in a path.
N_LOG_N = np.concatenate([[0.0], np.arange(1, 1024) * np.log2(np.arange(1, 1024))])
LETTERS = ("aeiou", "bcdfghjklmnpqrstvwxyz", DIGITS)
MARKS = ("/", "-", "".join(c for c in map(chr, range(128)) if not c.isalnum() and not c.isspace() and c not in "_/.-") + "\x1c\x1d\x1e\x1f")
#: Patterns that are looked for in a path and query, and in a path alone.
IN_PATH = {"is_ugc_path": "/(user|profile|c|channel|u)/", "path_has_article_slug": r"/[a-z0-9-]+-\d{4,}/?", "path_has_date": r"/20\d{2}/\d{1,2}/"}
ANY = "(?i)" + "|".join(f"(?:{p})" for p in CONTENT.values())


def _profile(texts: pa.Array, kinds: tuple[str, ...] = LETTERS) -> list[np.ndarray]:
    """Of each text: its entropy, and how many of its characters are in each of kinds. Bytes are counted for all texts at once, and
    by characters where a text has others than ASCII. Nulls count as empty."""
    texts = texts.fill_null("").cast(pa.large_binary())
    n, ends = len(texts), np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]] if n else np.zeros(0, np.uint8)
    size = np.diff(ends)
    row = np.repeat(np.arange(n), size)
    counts = np.bincount(row * 128 + (data & 127), minlength=n * 128).reshape(n, 128)
    plain = N_LOG_N[counts] if counts.max(initial=0) < len(N_LOG_N) else counts * np.log2(np.maximum(counts, 1))
    repeats, found = plain.sum(1), [counts[:, np.frombuffer(x.encode(), np.uint8)].sum(1) for x in kinds]
    for i in np.unique(row[data > 127]):
        of = Counter(texts[int(i)].as_py().decode())
        size[i], repeats[i] = of.total(), sum(k * np.log2(k) for k in of.values())
        for place, letters in zip(found, kinds, strict=True):
            place[i] = sum(of[x] for x in letters)
    some = np.maximum(size, 1)
    return [np.where(size > 1, np.log2(some) - repeats / some, 0.0), *found]


def _entropy(texts: pa.Array) -> pa.Array:
    return pa.array(_profile(texts)[0])


def _letters(hosts: pa.Array) -> pa.Array:
    of = pc.dictionary_encode(hosts.fill_null(""))
    entropy, *counts = _profile(of.dictionary)
    found = pa.StructArray.from_arrays([pa.array(entropy), *[pa.array(x.astype(np.int32)) for x in counts]], ["entropy", "vowels", "consonants", "digits"])
    return found.take(of.indices)


def _contents(paths: pa.Array, queries: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(paths.fill_null(""), queries.fill_null(""), pa.scalar("?", paths.type))


def _looked(texts: pa.Array, patterns: list[str]) -> np.ndarray:
    """Of each text a number with a bit for each of the patterns that is found in it."""
    bits = np.zeros(len(texts), np.int32)
    for i, pattern in enumerate(patterns):
        bits |= pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(np.int32) << i
    return bits


def _in_content(contents: pa.Array, start: str) -> np.ndarray:
    """_looked for CONTENT; one search tells the texts that have none of it in whatever case."""
    some = pc.match_substring_regex(contents, ANY)
    bits = np.zeros(len(contents), np.int32)
    bits[some.to_numpy(zero_copy_only=False)] = _looked(contents.filter(some), [start + p for p in CONTENT.values()])
    return bits


def _paths(paths: pa.Array, queries: pa.Array) -> pa.Array:
    entropy, slashes, hyphens, odd = _profile(paths, MARKS)
    plain = pc.equal(pc.binary_length(paths), pc.utf8_length(paths)).fill_null(True).to_numpy(zero_copy_only=False)
    found = _in_content(_contents(paths, queries), "") | _looked(paths.fill_null(""), list(IN_PATH.values())) << len(CONTENT)
    values = [entropy, *[x.astype(np.int32) for x in (slashes, hyphens, np.where(plain, odd, -1), found)]]
    return pa.StructArray.from_arrays([pa.array(x) for x in values], IN_PATHS.names)


def _any_case(paths: pa.Array, queries: pa.Array) -> pa.Array:
    return pa.array(_in_content(_contents(paths, queries), "(?i)"))


IN_PATHS = StructType([StructField("entropy", DoubleType()), *[StructField(name, IntegerType()) for name in ("slashes", "hyphens", "odd", "found")]])
COUNTED = StructType([StructField("entropy", DoubleType()), *[StructField(name, IntegerType()) for name in ("vowels", "consonants", "digits")]])


def letters(host: Column) -> Column:
    """(entropy, vowels, consonants, digits) of hosts, taken once for each of a batch."""
    return F.arrow_udf(_letters, COUNTED)(host)


def profiled(path: Column, query: Column) -> Column:
    """(entropy, slashes, hyphens, odd, found) of paths: odd characters, -1 where there are others than ASCII, and a bit for each of
    CONTENT and IN_PATH that is found."""
    return F.arrow_udf(_paths, IN_PATHS)(path, query)


def entropy(text: Column) -> Column:
    """Shannon entropy in bits of a character; 0 for up to one character and for null."""
    return F.arrow_udf(_entropy, DoubleType())(text)


def fingerprint(url: Column) -> Column:
    return F.substring(F.sha2(url, 256), 1, 16)


def counted(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def occurrences(text: Column, chars: str) -> Column:
    """How many of the text's characters are among chars."""
    rest = F.replace(text, F.lit(chars), F.lit("")) if len(chars) == 1 else F.translate(text, chars, "")
    return F.length(text) - F.length(rest)


def _words(pattern: str) -> list[str]:
    """The alternatives of a pattern's group as plain texts, of which one is in every text that the pattern finds."""
    plain = [x.replace("\\.", ".") for x in pattern[pattern.index("(") + 1 : pattern.rindex(")")].split("|")]
    return [x.replace("[1-9]", d) for x in plain for d in (DIGITS[1:] if "[1-9]" in x else "0")]


def holds(text: Column, pattern: str, any_case: bool = False) -> Column:
    """Whether a pattern of alternatives is found in the text. It is searched for only where one of its words occurs, as it
    costs many times more."""
    folded = F.lower(text) if any_case else text
    return reduce(lambda a, b: a | b, [folded.contains(w) for w in _words(pattern)]) & text.rlike(f"(?i){pattern}" if any_case else pattern)


def keyword_pattern(words: list[str]) -> str | None:
    """Alternation of escaped keywords, longest first; None without keywords."""
    quoted = ["\\Q" + w.replace("\\E", "\\E\\\\E\\Q") + "\\E" for w in sorted(words, key=lambda w: (-len(w), w))]
    return "|".join(quoted) or None


def among(text: Column, words: list[str], few: int = 16) -> Column:
    """Whether the text contains one of the words: a few are looked for one by one, which costs less than a pattern."""
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words]) if len(words) <= few else text.rlike(keyword_pattern(words))


def tld_flags(host: Column, profile) -> dict[str, Column]:
    """The suffix flags under a profile."""
    dots = "" if profile.tld_mode == "documented" else "."
    return {"suspicious_tld": tld(host).isin(*[dots + x for x in SUSPICIOUS_TLDS]), "trustworthy_tld": tld(host).isin(*[dots + x for x in TRUSTWORTHY_TLDS])}


def rule_features(rows: DataFrame, profile, nsfw: list[str] = (), spam: list[str] = ()) -> DataFrame:
    """Adds the rule model's features to (url, timestamp, domain, path, query). Flags are booleans. Membership in host lists
    is added by scoring, as a join."""
    url, host, path, query = (F.col(c) for c in ("url", "domain", "path", "query"))
    rows = rows.withColumns({"_host": letters(host), "_path": profiled(path, query)})
    content, in_host, in_path = F.concat(path, F.lit("?"), query), F.col("_host"), F.col("_path")
    size = F.coalesce(F.length(url), F.lit(0))
    words = lambda keys: among(content, list(keys)) if keys else F.lit(False)
    found = {
        "very_short_url": size <= 15,
        "very_long_url": size > 1024,
        "no_scheme": ~F.coalesce(url.contains("://"), F.lit(False)),
        "path_keyword_stuffing": (in_path["slashes"] > 10) & (in_path["hyphens"] > 10),
        **tld_flags(host, profile),
        "has_ip_address": host.rlike(IP),
        "excessive_subdomains": occurrences(host, ".") > 4,
        "is_url_shortener": holds(host, SHORTENER),
        "suspicious_chars_path": F.when(in_path["odd"] < 0, counted(path, r"(?U)[^\w\s/.-]")).otherwise(in_path["odd"]) > 3,
        "excessive_encoding": F.coalesce(occurrences(url, "%"), F.lit(0)) > 5,
        "excessive_params": occurrences(query, "&") > 9,
        "long_query": F.length(query) > 150,
        "short_domain": F.length(host) < 6,
        "very_long_domain": F.length(host) > 25,
        "domain_is_numeric_heavy": in_host["digits"] / F.greatest(F.length(host), F.lit(1)) > 0.4,
        "domain_hyphen_heavy": occurrences(host, "-") > 2,
        "domain_entropy": in_host["entropy"],
        "vowel_consonant_ratio": in_host["vowels"] / F.greatest(in_host["consonants"], F.lit(1)),
        "is_malformed_url": host == UNKNOWN,
        "has_invalid_timestamp": F.col("timestamp").isNull(),
        "path_entropy": in_path["entropy"],
        "path_depth": in_path["slashes"],
        "is_root_page": path.isin("/", ""),
        "path_is_descriptive": (in_path["hyphens"] >= 2) & (F.length(path) > 15),
        "is_nsfw_content": words(nsfw),
        "is_spam_content": words(spam),
    }
    found |= {name: in_path["found"].bitwiseAND(F.lit(1 << i)) > 0 for i, name in enumerate([*CONTENT, *IN_PATH])}
    return rows.withColumns(found).drop("_host", "_path")


def model_features() -> dict[str, Column]:
    """The 42 inputs of the trained model in their order, from rule features and (url, domain, path, query); patterns ignore case."""
    host, path, query, url = (F.col(c) for c in ("domain", "path", "query", "url"))
    one = lambda c: c.cast("int")
    content = F.arrow_udf(_any_case, IntegerType())(path, query)
    params = occurrences(query, "&") + one(query != "")
    article = F.col("path_has_article_slug") | F.col("path_has_date") | F.col("path_is_descriptive")
    readable = (F.col("domain_entropy") < 3.3) & ~F.col("domain_is_numeric_heavy") & ~F.col("domain_hyphen_heavy")
    out = {
        "len_url": F.length(url), "len_path": F.length(path), "len_query": F.length(query), "len_domain": F.length(host),
        "is_very_short_url": one(F.col("very_short_url")), "is_very_long_url": one(F.col("very_long_url")),
        "is_suspicious_tld": one(F.col("suspicious_tld")), "is_trustworthy_tld": one(F.col("trustworthy_tld")), "has_ip_address": one(F.col("has_ip_address")),
        "num_subdomains": occurrences(host, "."), "has_excessive_subdomains": one(F.col("excessive_subdomains")),
        "num_path_dirs": F.col("path_depth"), "is_root_path": one(F.col("is_root_page")),
        "num_params": params, "has_excessive_params": one(params > 9),
        "num_digits_domain": occurrences(host, DIGITS), "digit_ratio_domain": occurrences(host, DIGITS) / F.greatest(F.length(host), F.lit(1)), "domain_is_numeric_heavy": one(F.col("domain_is_numeric_heavy")),
        "num_hyphens_domain": occurrences(host, "-"), "domain_hyphen_heavy": one(F.col("domain_hyphen_heavy")),
        "has_suspicious_chars_path": one(F.col("suspicious_chars_path")), "has_excessive_encoding": one(F.col("excessive_encoding")), "path_keyword_stuffing": one(F.col("path_keyword_stuffing")),
    }
    out |= {name: one(content.bitwiseAND(F.lit(1 << i)) > 0) for i, name in enumerate(CONTENT)}
    out |= {name: F.col(name) for name in ("domain_entropy", "path_entropy", "vowel_consonant_ratio")}
    out |= {name: one(F.col(name)) for name in ("is_ugc_path", "path_has_article_slug", "path_has_date", "path_is_descriptive")}
    out |= {"is_quality_article": one(readable & article)}
    return out | {name: one(F.col(name)) for name in ("is_nsfw_content", "is_spam_content", "is_nsfw_domain", "is_quality_domain", "is_news_domain")}
