"""Scalar text functions as Column expressions: tokens, sections, rhetoric, risk, intent, redaction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and word lists that results depend on.
CJK = r"[㐀-䶿一-鿿豈-﫿]+"
CJK_CHAR = r"[㐀-䶿一-鿿]"
BIGRAM_MARK = "__kh_cjk_bigrams__"
LEXICAL = r"[A-Za-z0-9]+(?:[-'][A-Za-z0-9]+)*|" + CJK_CHAR
RISK = {
    "unsupported_superlative": r"\b(?:best|first|only|unprecedented|state[- ]of[- ]the[- ]art)\b",
    "exaggerated_novelty": r"\b(?:novel|groundbreaking|revolutionary|breakthrough)\b",
    "vague_claim": r"\b(?:significant|substantial|considerable|remarkable)\b",
    "causal_overclaim": r"\b(?:causes?|proves?|ensures?|guarantees?|leads? to)\b",
}
COMPARISON = r"\b(?:than|compared|relative to|versus|baseline|prior work)\b"
ASSIGNMENT = r"(?i)(\b(?:zotero[-_]?api[-_]?key|api[-_]?key|authorization)\b\s*[:=]\s*)(?:(?:bearer|basic)\s+)?([^\s,;&]+)"
KEY_PARAMETER = r"(?i)([?&](?:api[-_]?key|key)=)([^&#\s]+)"
CITATION = r"\[(?:\d+[ ,;-]*)+\]|\([A-Z][A-Za-z-]+(?: et al\.)?,? \d{4}[a-z]?\)"
NUMBER = r"\b\d+(?:\.\d+)?%?\b"
FORMULA = r"[$\\][^\n]{2,}|[=<>]\s*[A-Za-z0-9_{}^]+"
GAP = r"(?i)\b(however|nevertheless|despite|although|remain(?:s)?|lack(?:s|ing)?|limited|challenge|few studies|has not|have not|still (?:fails?|requires?|suffers?))\b"
SECTION_NUMBER = r"^\s*(?:(?:section|chapter|appendix)\s+)?(?:[a-z]\.\d+(?:\.\d+)*|\d+(?:\.\d+)*|[ivxlcdm]+)(?:\s*[.):-]\s*|\s+)"
SECTION_SEPARATORS = r"[^a-z0-9㐀-䶿一-鿿]+"
FAMILIES = {
    "introduction": ["introduction", "introduction and motivation", "overview", "引", "引言", "绪论"],
    "related_work": ["background", "related work", "related works", "literature review", "背景", "相关工作", "文献综述"],
    "method": ["approach", "materials and methods", "method", "methodology", "methods", "our approach", "proposed approach", "proposed method", "方法", "方法论", "研究方法"],
    "experiment": ["analysis", "evaluation", "experiment", "experimental results", "experiments", "result", "results", "实验", "实验结果", "结果", "结果与分析"],
    "conclusion": ["conclusion", "conclusions", "conclusion and discussion", "discussion", "总结", "结论", "讨论", "展望", "未来展望", "总结与展望", "结论与展望"],
}
FAMILY_PREFIXES = {
    "introduction": r"^(?:introduction|引言|绪论)\b",
    "related_work": r"^(?:(?:additional\s+)?related works?|background|literature review|相关工作|背景|文献综述)\b",
    "method": r"^(?:materials and methods|methods?|methodology|approach|our approach|proposed (?:method|methodology|approach)|方法论?|研究方法)\b",
    "experiment": r"^(?:experiments?|experimental|evaluation|results?|analysis|quantitative results?|quantitive results?|generalization results?|comparing\b|实验|结果|分析)\b",
    "conclusion": r"^(?:conclusions?|discussion|结论|讨论|总结)\b",
}
CODE_INTENTS = {
    "debug": r"traceback|exception|error|报错|异常|崩溃",
    "compatibility": r"compatib|version|版本|弃用|deprecated|breaking",
    "migration": r"migrat|upgrade|迁移|升级",
    "implementation": r"implement|源码|source|内部实现|调用链",
    "api_usage": r"how to|example|参数|用法|api|示例",
}
ASSET_INTENTS = {"strategy": r"\bstrateg(?:y|ies)\b|写作策略|策略", "template": r"\btemplates?\b|写作模板|模板", "phrase": r"\bphrases?\b|表达短语|短语"}
TASK_TAGS = {
    "compatibility": ["compatib", "breaking", "version"],
    "migration": ["migrat", "upgrade"],
    "deprecation": ["deprecat"],
    "debug": ["error", "exception", "bug", "fix"],
    "installation": ["install"],
    "configuration": ["config"],
    "performance": ["performance", "memory", "speed"],
}
SENTENCE_ROLES = {
    "identify_gap": "however|although|despite|remain|limitation|lack",
    "introduce_solution": "we (propose|present|introduce)|our method",
    "compare_baseline": "outperform|compared|higher|lower",
    "derive_implication": "because|suggest|indicate|therefore",
}
STOP_WORDS = ["about", "after", "also", "because", "been", "before", "between", "from", "have", "into", "method", "paper", "results", "that", "their", "these", "this", "using", "were", "which", "with"]
CREDENTIALS = r"(?i)([a-z][a-z0-9+.-]*://)[^/\s@]+@"
INJECTION = r"(?i)(ignore (all|any|the) (previous|prior) instructions|system prompt|developer message|you are (chatgpt|an ai)|exfiltrat|reveal.*secret|执行.*指令|忽略.*指令)"
EXPECTED_FAMILY = {"result_reporting": "experiment", "result_interpretation": "experiment", "limitation_acknowledgment": "conclusion", "future_work": "conclusion"}


#: What a paragraph does in a section of a family: the first pattern it holds, or the one without a pattern.
RHETORIC = {
    "introduction": [
        ("(?i)we (?:propose|present|introduce)|our contribution", "contribution_statement"),
        (GAP, "research_gap"),
        ("(?i)motiv|therefore|to address", "motivation"),
        (None, "background"),
    ],
    "related_work": [("(?i)whereas|unlike|compared", "method_comparison"), (None, "method_summary")],
    "method": [("(?i)because|in order to|allows us", "design_rationale"), (None, "method_overview")],
    "experiment": [
        (r"(?i)\b(?:outperform|higher|lower|increase|decrease|improv\w*\s+by|compared (?:with|to)|versus)\b", "quantitative_comparison"),
        ("(?i)indicat|suggest|because", "result_interpretation"),
        (None, "experimental_setup"),
    ],
    "conclusion": [
        (r"(?i)\bfuture|will (?:investigate|explore|study|extend)\b", "future_work"),
        (r"(?i)\b(?:remain|limitation|limited|challenge|cannot|fails?)\b", "limitation"),
        (None, "work_summary"),
    ],
}
CAPTION, LATIN_WORD = r"(?i)^\s*(?:figure|fig\.|table|图|表)\s*\d+", r"[A-Za-z]+(?:[-'][A-Za-z]+)*"


def _first(rules: list[tuple[Column, Column]], default: Column) -> Column:
    """The value of the first rule that holds."""
    return reduce(lambda rest, rule: F.when(rule[0], rule[1]).otherwise(rest), reversed(rules), default)


def collapsed(text: Column) -> Column:
    """White space runs as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def sparse_text(text: Column, mark: str = BIGRAM_MARK) -> Column:
    """The text, followed by a mark and its distinct CJK bigrams in order of appearance if it has any."""
    runs = F.regexp_extract_all(text, F.lit(CJK), 0)
    pairs = F.transform(runs, lambda r: F.when(F.length(r) == 1, F.array(r)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.length(r) - 1, F.lit(1))), lambda i: F.substring(r, i, F.lit(2)))))
    tokens = F.array_distinct(F.flatten(pairs))
    return F.when(F.size(tokens) > 0, F.concat(text, F.lit(f"\n{mark} "), F.array_join(tokens, " "))).otherwise(text)


def token_count(text: Column) -> Column:
    """White space separated tokens, 1 at least."""
    return F.greatest(F.lit(1), F.size(F.split(collapsed(text), " "))).cast("bigint")


def token_estimate(text: Column) -> Column:
    """The larger of word or punctuation tokens and a quarter of the characters."""
    return F.greatest(F.regexp_count(text, F.lit(r"(?U)\w+|[^\w\s]")), F.ceil(F.length(text) / 4)).cast("bigint")


def sentences(text: Column) -> Column:
    """The non-empty sentences, ended by western or CJK marks."""
    return F.filter(F.transform(F.split(text, r"(?<=[.!?。！？])\s*"), lambda s: F.trim(s)), lambda s: s != "")


def lexical_tokens(text: Column) -> Column:
    """Latin words, which may hold hyphens and apostrophes, and single CJK characters."""
    return F.regexp_extract_all(text, F.lit(LEXICAL), 0)


def section_heading(value: Column) -> Column:
    """A heading without numbering, lower-cased, separators as blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(value)), SECTION_NUMBER, ""), SECTION_SEPARATORS, " "))


def section_family(value: Column) -> Column:
    heading = section_heading(value)
    rules = [(heading.isin(names), F.lit(family)) for family, names in FAMILIES.items()]
    rules += [(heading.rlike("(?U)" + pattern), F.lit(family)) for family, pattern in FAMILY_PREFIXES.items()]
    rules.append((heading.rlike(r"\bexperiments?$"), F.lit("experiment")))
    return _first(rules, F.when(heading == "", F.lit("other")).otherwise(heading))


def masked(text: Column) -> Column:
    """Citations, then numbers, as placeholders."""
    return F.regexp_replace(F.regexp_replace(text, CITATION, "[CITATION]"), NUMBER, "[VALUE]")


def rhetorical_function(value: Column, family: Column) -> Column:
    """What a paragraph (white space collapsed) does in a section of a family; null outside the known
    families, for formulas and for unusual lengths. Both should be plain columns, since the rules repeat them."""

    rules = [((family == name) if pattern is None else (family == name) & value.rlike(pattern), function) for name, own in RHETORIC.items() for pattern, function in own]
    usable = F.length(value).between(60, 1800) & ~value.rlike(FORMULA)
    return F.when(usable, _first([(rule, F.lit(name)) for rule, name in rules], F.lit(None).cast("string")))


def rule_quality(value: Column) -> Column:
    """Quality of a paragraph (white space collapsed) by its length, start, citations and end."""
    score = (
        F.lit(0.55)
        + F.when(F.length(value).between(90, 900), 0.15).otherwise(0.0)
        + F.when(value.rlike(r"^(This|It|They|These|Those)\b"), 0.0).otherwise(0.1)
        - F.when(value.rlike(CITATION), 0.05).otherwise(0.0)
        + F.when(F.right(value, F.lit(1)).isin(".", "!", "?"), 0.05).otherwise(0.0)
    )
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def sentence_roles(text: Column) -> Column:
    """Each sentence's role in its paragraph."""

    def role(sentence: Column, i: Column) -> Column:
        lowered = F.lower(sentence)
        rules = [(lowered.rlike(pattern), F.lit(name)) for name, pattern in SENTENCE_ROLES.items()]
        return _first(rules, F.when(i == 0, F.lit("establish_context")).otherwise(F.lit("summarize_progress")))

    return F.transform(sentences(collapsed(text)), role)


def transitions(roles: Column) -> Column:
    """Neighbouring roles as "a_to_b"."""
    n = F.size(roles)
    return F.when(n > 1, F.zip_with(F.slice(roles, F.lit(1), F.greatest(n - 1, F.lit(1))), F.slice(roles, F.lit(2), F.greatest(n - 1, F.lit(1))), lambda a, b: F.concat(a, F.lit("_to_"), b))).otherwise(F.array().cast("array<string>"))


def language(text: Column) -> Column:
    cjk, latin = F.regexp_count(text, F.lit(CJK_CHAR)), F.regexp_count(text, F.lit("[A-Za-z]"))
    return F.when(cjk > latin * 0.2, "zh").when(latin > 0, "en").otherwise("und")


def material_quality(text: Column, category: Column, family: Column, confidence: Column, flags: Column) -> Column:
    """Weighted quality of a writing material, to six places."""
    words = F.regexp_count(text, F.lit("[A-Za-z0-9-]+|" + CJK_CHAR))
    expected = _first([(category == c, F.lit(f)) for c, f in EXPECTED_FAMILY.items()], F.lit(None).cast("string"))
    value = (
        0.20 * confidence
        + 0.20 * F.when(words.between(8, 80), 1.0).otherwise(0.6)
        + 0.15 * F.when(text.rlike(r"^(?:This|It|These|Those|They)\b"), 0.6).otherwise(1.0)
        + 0.15 * F.when(F.rtrim(text).rlike(r"[.?!。？！]$"), 1.0).otherwise(0.7)
        + 0.15 * F.when(F.length(F.trim(text)) >= 20, 1.0).otherwise(0.5)
        + 0.15 * F.when(expected.isNull() | (family == expected), 1.0).otherwise(0.5)
        - F.least(F.lit(0.25), 0.05 * F.size(F.array_distinct(flags)))
    )
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)), 6)


def code_intent(query: Column) -> Column:
    return _first([(query.rlike("(?i)" + p), F.lit(name)) for name, p in CODE_INTENTS.items()], F.lit("source_understanding"))


def asset_intent(query: Column) -> Column:
    """The asset type that alone fits the query, else null."""
    found = F.array_compact(F.array(*(F.when(query.rlike("(?i)" + p), F.lit(name)) for name, p in ASSET_INTENTS.items())))
    return F.when(F.size(found) == 1, F.element_at(found, 1))


def task_tags(source_type: Column, text: Column) -> Column:
    lowered = F.lower(text)
    found = [F.when(reduce(lambda a, b: a | b, (lowered.contains(w) for w in words)), F.lit(tag)) for tag, words in TASK_TAGS.items()]
    example = source_type.isin("example", "tutorial")
    found += [F.when(example, F.lit("example")), F.when(example, F.lit("api_usage")), F.when(source_type == "source_code", F.lit("implementation"))]
    return F.array_sort(F.array_compact(F.array(*found)))


def source_type_of_path(path: Column) -> Column:
    lowered = F.lower(path)
    name = F.element_at(F.split(lowered, "/"), -1)
    rooted = F.concat(F.lit("/"), lowered)
    rules = [
        (lowered.contains("migration"), "migration_guide"),
        (name.contains("changelog") | name.contains("release"), "changelog"),
        (lowered.endswith(".py"), "source_code"),
        (rooted.contains("/examples/"), "example"),
        (rooted.contains("/tutorial"), "tutorial"),
        (name.startswith("readme"), "repository_readme"),
    ]
    return _first([(rule, F.lit(kind)) for rule, kind in rules], F.lit("api_documentation"))


def redacted(text: Column, mark: str = "[REDACTED]") -> Column:
    """Values of key assignments and of key parameters in URLs as a mark."""
    return F.regexp_replace(F.regexp_replace(text, ASSIGNMENT, f"$1{mark}"), KEY_PARAMETER, f"$1{mark}")


def without_credentials(text: Column, mark: str = "<redacted>") -> Column:
    """User names and passwords in URLs as a mark."""
    return F.regexp_replace(text, CREDENTIALS, f"$1{mark}@")


def without_secrets(text: Column, secrets: list[str], mark: str = "[REDACTED]") -> Column:
    """Known secrets as a mark, longer ones first, then assignments and parameters."""
    return redacted(reduce(lambda done, secret: F.replace(done, F.lit(secret), F.lit(mark)), sorted(filter(None, secrets), key=len, reverse=True), text), mark)


def profile_terms(text: Column) -> Column:
    """Words of four Latin letters or hyphens or more that aren't stop words, then the bigrams of CJK runs, with repeats."""
    words = F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"(?U)\b[A-Za-z][A-Za-z-]{3,}\b"), 0), F.lower), lambda w: ~w.isin(STOP_WORDS))
    runs = F.filter(F.regexp_extract_all(text, F.lit(CJK), 0), lambda r: F.length(r) > 1)
    pairs = F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, F.lit(2))))
    return F.concat(words, F.flatten(pairs))


def risk_flags(text: Column, category: Column) -> Column:
    """Sorted flags of claims that need support."""
    found = [F.when(text.rlike("(?i)" + p) & (~text.rlike(r"\d") if flag == "vague_claim" else F.lit(True)), F.lit(flag)) for flag, p in RISK.items()]
    found.append(F.when((category == "incremental_novelty_positioning") & ~text.rlike("(?i)" + COMPARISON), F.lit("missing_comparison")))
    return F.array_sort(F.array_compact(F.array(*found)))


def page_numbers(start: Column, end: Column) -> Column:
    return F.when(start.isNull() | end.isNull() | (end < start), F.array().cast("array<bigint>")).otherwise(F.sequence(start, end))


def excluded_material(text: Column) -> Column:
    """Captions, and texts without CJK and with fewer than 12 Latin words."""
    return text.rlike(CAPTION) | (~text.rlike(CJK_CHAR) & (F.regexp_count(text, F.lit(LATIN_WORD)) < 12))


def marked(text: Column, most: int) -> tuple[Column, Column, Column]:
    """A text cut to a length, whether it was cut, and whether it looks like an injected instruction."""
    return F.left(text, F.lit(most)), F.length(text) > most, text.rlike(INJECTION)
