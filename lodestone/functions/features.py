"""Facets of paragraphs, labels and inferences as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.text import CJK_CHAR, LEXICAL, section_family, sentences

# Patterns, word lists and tables that results depend on.
FIRST_PERSON = r"\b(?:we|our|ours|us)\b"
PASSIVE = r"\b(?:is|are|was|were|be|been|being)\s+\w+(?:ed|en)\b"
CAUTIOUS = r"\b(?:may|might|could|appears?|suggests?|likely|potentially)\b"
STRONG = r"\b(?:clearly|significantly|substantially|demonstrates?|proves?|always)\b"
CRITICAL = r"\b(?:fail(?:s|ed)?|shortcoming|drawback|severe|fundamental limitation)\b"
MATH = r"\$[^$]+\$|\\\(|\\\[|\\begin\{|\b[A-Za-z]\s*=\s*[^,.;]+"
TRANSITION = r"\b(?:however|therefore|moreover|furthermore|consequently|nevertheless|in contrast|for example|specifically|thus|although|despite)\b"
CJK_FIRST_PERSON = "我们|本人|我"
CJK_PASSIVE = "被|受到|由[^，。！？]{0,20}(?:完成|执行|实现|进行)"
CJK_CAUTIOUS = "可能|或许|似乎|表明|建议|需要进一步|尚需|不确定"
CJK_STRONG = "显然|明显|完全|证明|始终|必然|显著"
CJK_CRITICAL = "失败|缺点|不足|严重|根本性限制|局限"
CJK_TRANSITION = "然而|因此|此外|进一步|相反|例如|具体而言|尽管|虽然|但是"
BULLET = r"^(?:[-*+]\s+|\d+[.)]\s+)"
CONTRIBUTION, CJK_CONTRIBUTION = r"\b(?:we (?:propose|present|introduce)|our contributions?)\b", "(?:我们|本文)(?:提出|介绍|引入)"
FIGURE, CJK_FIGURE = r"\b(?:fig(?:ure)?|table)\s*\d+", r"(?:图|表)\s*[一二三四五六七八九十\d]+"
ANALYSIS, CJK_ANALYSIS = r"\b(?:results? (?:show|indicate|suggest)|because|we observe)\b", "(?:结果|实验)(?:表明|显示)|由于|我们观察到"
ABBREVIATION = r"\b[A-Z][A-Z0-9-]{1,9}\b"
SECTION_LABELS = {"introduction": "Introduction", "related_work": "Related Work", "method": "Method", "experiment": "Experiment", "conclusion": "Conclusion"}
RELEASE_CATEGORIES = {
    "breaking": "breaking_changes",
    "deprecat": "deprecations",
    "security": "security",
    "migrat": "migration",
    "performance": "performance",
    "bug": "bug_fixes",
    "fix": "bug_fixes",
    "known issue": "known_issues",
}
DOMAINS = {
    "computer_vision": r"\b(?:image|visual|vision|object detection|diffusion model)\b",
    "graph_learning": r"\b(?:graph|gnn|node|edge)\b",
    "language_or_multimodal_models": r"\b(?:language model|llm|lmm|multimodal)\b",
    "differential_equations": r"\b(?:ordinary differential|neural ode|time-series)\b",
}
VENUES = r"\b(?:NeurIPS|NIPS|ICLR|ICML|CVPR|ECCV|ICCV|AAAI|ACL|EMNLP|IEEE\s+TIP)\b"
BIBLIOGRAPHY = ["bibliography", "literature cited", "reference", "references", "works cited", "参考文献", "参考资料"]
CANDIDATE_SIGNAL = (
    r"\b(?:however|although|despite|remain|lack|limited|challenge|motivat|we (?:propose|present|introduce)|our contribution|result|outperform|"
    r"suggest|indicat|limitation|future work|important|critical)\b"
)
#: What writing materials are about, and what of it is extracted first.
TAXONOMY = (
    "concept_introduction",
    "concept_definition",
    "context_setting",
    "importance_claim",
    "problem_statement",
    "gap_identification",
    "prior_work_limitation",
    "motivation",
    "incremental_novelty_positioning",
    "contribution_summary",
    "design_rationale",
    "mechanism_explanation",
    "transition",
    "comparison_with_prior_work",
    "result_reporting",
    "result_interpretation",
    "ablation_interpretation",
    "limitation_acknowledgment",
    "future_work",
)
MVP_TAXONOMY = (
    "context_setting",
    "importance_claim",
    "problem_statement",
    "gap_identification",
    "prior_work_limitation",
    "motivation",
    "incremental_novelty_positioning",
    "contribution_summary",
    "result_reporting",
    "result_interpretation",
    "limitation_acknowledgment",
    "future_work",
)
#: Where each intent looks first, and what evidence comes first.
SOURCE_PRIORITIES = {
    "api_usage": ("api_documentation", "tutorial", "example", "source_code"),
    "implementation": ("api_documentation", "example", "source_code", "tutorial"),
    "debug": ("source_code", "version_diff", "release_note", "issue", "pull_request"),
    "compatibility": ("version_diff", "migration_guide", "release_note", "api_documentation", "source_code"),
    "migration": ("migration_guide", "version_diff", "release_note", "api_documentation", "example"),
    "source_understanding": ("source_code", "api_documentation", "example"),
}
EVIDENCE_ROLES = ("exact_symbol_source", "target_version_evidence", "current_version_evidence", "change_evidence", "retrieved_evidence")
BIBLIOGRAPHY_QUERY = r"\b(?:bibliograph(?:y|ies)|citations?|references?|works cited)\b|参考文献|引用列表"
#: What each rhetorical function is written like: its pattern, its moves and when to use it.
WRITING_PATTERNS = {
    "research_gap": (
        "Although [prior progress or prevailing approach], [unresolved limitation or missing capability] remains.",
        ("acknowledge_prior_progress", "identify_limitation"),
        "Use to connect established progress to a precise, evidence-backed research gap.",
    ),
    "contribution_statement": (
        "To address [problem], we introduce [method or contribution], which [main capability].",
        ("state_problem", "present_contribution", "preview_benefit"),
        "Use after the gap and motivation have been established.",
    ),
    "motivation": (
        "This limitation motivates [research direction] to achieve [desired capability].",
        ("identify_limitation", "motivate_direction"),
        "Use as a transition from the gap to the proposed approach.",
    ),
    "background": (
        "[Research topic] has become important because [context or impact].",
        ("establish_topic", "explain_significance"),
        "Use to establish context before narrowing to the specific problem.",
    ),
    "research_context": (
        "[Research topic] has become important because [context or impact].",
        ("establish_topic", "explain_significance"),
        "Use to establish context before narrowing to the specific problem.",
    ),
    "method_comparison": (
        "Whereas [method A] emphasizes [property], [method B] addresses [contrasting property].",
        ("describe_first_method", "contrast_second_method"),
        "Use only when both sides of the comparison are supported by citations.",
    ),
    "method_summary": (
        "Prior work approaches [problem] through [method family or principle].",
        ("identify_work", "summarize_method"),
        "Use for concise, source-backed related-work summaries.",
    ),
    "design_rationale": (
        "We adopt [design choice] because it enables [desired property].",
        ("state_design", "justify_design"),
        "Use when the causal link between design and benefit is demonstrable.",
    ),
    "method_overview": (
        "The proposed method consists of [components] that jointly perform [objective].",
        ("introduce_method", "summarize_components"),
        "Use at the beginning of a method section.",
    ),
    "result_interpretation": (
        "The results indicate [finding], suggesting that [supported interpretation].",
        ("report_finding", "interpret_finding"),
        "Keep interpretation within the evidence supplied by the experiment.",
    ),
    "quantitative_comparison": (
        "Compared with [baseline], [method] changes [metric] by [supported amount].",
        ("identify_baseline", "report_quantitative_difference"),
        "Use only with an explicit metric, direction and supported comparison.",
    ),
    "experimental_setup": (
        "We evaluate [method] on [data or setting] using [metrics and protocol].",
        ("state_subject", "describe_protocol"),
        "Use to make experimental conditions reproducible.",
    ),
    "future_work": (
        "Future work will investigate [open limitation] in [broader setting].",
        ("acknowledge_limitation", "propose_future_direction"),
        "Use for concrete limitations rather than generic aspirations.",
    ),
    "limitation": (
        "A remaining limitation is [bounded constraint], which affects [scope or setting].",
        ("acknowledge_limitation", "bound_impact"),
        "State only limitations supported by the source and keep their scope explicit.",
    ),
    "work_summary": (
        "This work addressed [problem] by introducing [approach] and demonstrated [finding].",
        ("restate_problem", "summarize_approach", "state_finding"),
        "Use for a concise conclusion without introducing new evidence.",
    ),
}


def _count(value: Column, latin: str, cjk: str) -> Column:
    return F.regexp_count(value, F.lit("(?iU)" + latin)) + F.regexp_count(value, F.lit(cjk))


def _has(value: Column, latin: str, cjk: str) -> Column:
    return value.rlike("(?iU)" + latin) | value.rlike(cjk)


def transition_markers(value: Column) -> Column:
    """Latin markers, lower-cased, then CJK ones, both in order of the text and with repeats."""
    return F.concat(F.transform(F.regexp_extract_all(value, F.lit("(?iU)" + TRANSITION), 0), F.lower), F.regexp_extract_all(value, F.lit(CJK_TRANSITION), 0))


def hundredths(part: Column, whole: Column) -> Column:
    """part / whole (integers, whole > 0) rounded to two places as IEEE arithmetic rounds the double quotient: to the nearest, and where the quotient lies
    halfway, by what its double is: above, below, or exactly halfway, which goes to the even digit."""
    double, twice = part / whole, (F.lit(200) * part).cast("bigint")
    whole_of = lambda c: F.floor(c).cast("bigint")
    k = F.call_function("div", twice, whole.cast("bigint"))
    half = (F.pmod(twice, whole) == 0) & (F.pmod(k, F.lit(2)) == 1)
    # the double as an integer of 2^-s, exactly: s leaves room for its 53 bits and fits in 62
    s = 61 - F.length(F.bin(whole_of(double)))
    scaled = whole_of(double * F.pow(F.lit(2.0), s)).cast("decimal(38,0)") * 200
    tie = k.cast("decimal(38,0)") * whole_of(F.pow(F.lit(2.0), s)).cast("decimal(38,0)")
    low = F.call_function("div", k - 1, F.lit(2).cast("bigint"))
    settled = F.when(scaled > tie, low + 1).when(scaled < tie, low).otherwise(low + F.pmod(low, F.lit(2)))
    return F.when(half, settled).otherwise(F.floor((twice + whole) / (whole * 2))) / 100


def paragraph_features(value: Column, raw: Column) -> list[Column]:
    """The facets of a paragraph. value: its text with white space collapsed, a plain column; raw: the text as it is."""
    cautious, strong, critical = _count(value, CAUTIOUS, CJK_CAUTIOUS), _count(value, STRONG, CJK_STRONG), _count(value, CRITICAL, CJK_CRITICAL)
    words, count = F.regexp_count(value, F.lit(LEXICAL)).cast("bigint"), F.greatest(F.lit(1), F.size(sentences(value)))
    return [
        words.alias("paragraph_word_count"),
        F.when(strong > cautious, "strong").when(cautious > strong, "cautious").otherwise("moderate").alias("expression_strength"),
        F.when(critical > 0, "critical").when(cautious > 0, "cautious").when(strong > 0, "assertive").otherwise("neutral").alias("tone"),
        value.rlike("(?U)" + MATH).alias("contains_math"),
        _has(value, FIRST_PERSON, CJK_FIRST_PERSON).alias("first_person"),
        _has(value, PASSIVE, CJK_PASSIVE).alias("passive_voice"),
        transition_markers(value).alias("transition_markers"),
        hundredths(words, count).alias("mean_sentence_words"),
        F.trim(F.regexp_replace(raw, r"(?U)^\s+", "")).rlike(BULLET).alias("bullet_or_numbered"),
        _has(value, CONTRIBUTION, CJK_CONTRIBUTION).alias("contribution_expression"),
        _has(value, FIGURE, CJK_FIGURE).alias("figure_table_reference"),
        _has(value, ANALYSIS, CJK_ANALYSIS).alias("analysis_expression"),
        F.regexp_extract_all(value, F.lit("(?U)" + ABBREVIATION), 0).alias("abbreviations"),
    ]


def section_label(heading: Column) -> Column:
    """A heading's family in title case, or Unknown."""
    labels = F.create_map(*(F.lit(x) for pair in SECTION_LABELS.items() for x in pair))
    return F.coalesce(F.try_element_at(labels, section_family(heading)), F.lit("Unknown"))


def writing_pattern(function: Column) -> Column:
    """(pattern, moves, usage) of a rhetorical function; null for others."""
    rows = [F.struct(F.lit(p).alias("pattern"), F.array(*map(F.lit, moves)).alias("moves"), F.lit(usage).alias("usage")) for p, moves, usage in WRITING_PATTERNS.values()]
    return reduce(lambda rest, i: F.when(function == list(WRITING_PATTERNS)[i], rows[i]).otherwise(rest), range(len(rows)), F.lit(None))


def release_category(text: Column) -> Column:
    """The category of the first keyword, in order of the categories, that the text holds."""
    lowered = F.lower(text)
    return F.coalesce(*(F.when(lowered.contains(word), category) for word, category in RELEASE_CATEGORIES.items()), F.lit("new_features"))


def normal_domain(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(value), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def inferred_domains(*texts: Column) -> Column:
    """The domains, sorted, that titles and texts suggest."""
    value = F.lower(F.concat_ws(" ", *(F.coalesce(t, F.lit("")) for t in texts)))
    return F.array_sort(F.array_compact(F.array(*(F.when(value.rlike("(?U)" + p), F.lit(name)) for name, p in DOMAINS.items()))))


def venue(publication: Column, candidates: Column) -> Column:
    """The publication, else the first known venue among the candidates (tags, collections)."""
    found = F.filter(F.transform(candidates, lambda c: F.regexp_extract(c, "(?iU)(" + VENUES + ")", 1)), lambda v: v != "")
    first = F.get(found, F.lit(0))
    return F.coalesce(F.nullif(F.trim(publication), F.lit("")), F.when(F.upper(first) == "NIPS", "NeurIPS").otherwise(first))


def structure_overlap(left: Column, right: Column) -> Column:
    """The share of the left text's distinct transition markers that the right text holds, 0 without any."""
    own, other = (F.array_distinct(F.regexp_extract_all(F.lower(t), F.lit("(?iU)" + TRANSITION), 0)) for t in (left, right))
    return F.when(F.size(own) == 0, 0.0).otherwise(F.size(F.array_intersect(own, other)) / F.size(own))


def is_bibliography(path: Column) -> Column:
    """Whether the last part of a section path (separated by ">", "/" or "::") is a list of references."""
    leaf = F.element_at(F.split(path, r"\s*(?:>|/|::)\s*"), -1)
    return F.coalesce(F.trim(F.regexp_replace(F.lower(leaf), r"[^a-z㐀-䶿一-鿿]+", " ")).isin(BIBLIOGRAPHY), F.lit(False))


def is_candidate(text: Column) -> Column:
    """Whether a paragraph is long, short and telling enough to be worth extracting."""
    units = F.regexp_count(text, F.lit("[A-Za-z0-9-]+|" + CJK_CHAR))
    return (units >= 8) & (F.length(text) <= 5000) & (text.rlike("(?iU)" + CANDIDATE_SIGNAL) | (units >= 20))


def citation_key(payload: Column) -> Column:
    """The citation key of a JSON record, lower-cased."""
    return F.lower(F.get_json_object(payload, "$.data.citationKey"))
