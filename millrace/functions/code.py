"""Predicates about code and prompts, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import text as T

#: What a line of code starts with, prose openings, completion phrases, first words of code.
KEYWORDS = ("def ", "class ", "return ", "import ", "from ", "for ", "while ", "if ", "elif ", "else:", "try:", "except ", "with ", "lambda ", "async ", "await ")
PROSE_STARTS = (
    "the given code", "the provided code", "this code", "this function", "this program", "to solve this problem", "to implement this",
    "here is an explanation", "here's an explanation", "in this solution", "we need to", "you can",
)
COMPLETION_PHRASES = (
    "return only the function body", "return only function body", "return only the method body", "return only method body", "function body only",
    "method body only", "complete the function body", "complete this function body", "complete the method body", "complete this method body",
    "implement the function body", "implement this function body", "implement the method body", "implement this method body",
    "fill in the function body", "fill in this function body", "fill in the method body", "fill in this method body",
    "replace the pass statement", "replace pass with",
)
CODE_STARTS = (
    "def ", "class ", "import ", "from ", "function ", "const ", "let ", "var ", "public ", "private ", "protected ", "#include", "using ", "package ",
    "func ", "fn ", "struct ", "enum ", "interface ", "#!/", "mv ", "cp ", "kubectl ", "minikube ",
)
#: Patterns of code, of fenced blocks, and of prompts; further phrases and kinds.
SYNTAX = r"\w+\s*=\s*[^=]|\w+\([^)]*\)|[{};]|==|!=|<=|>=|->|=>|\[[^\]]+\]"
FENCE = r"(?s)```(?:[a-zA-Z0-9_+\-.#]+)?\s*\n(.*?)```"
BODY_PROMPT = r"(?s)\b(complete|implement|fill in|write)\b.{0,120}\b(function|method)\b.{0,120}\bbody\b"
ONLY_BODY_PROMPT = r"(?s)\breturn only\b.{0,80}\b(function|method)\b.{0,40}\bbody\b"
MISSING_PROMPT = r"(?s)\b(fill in|complete)\b.{0,80}\b(missing code|todo|pass statement)\b"
CREATION_PROMPT = r"\b(implement|write|create|complete|add|build|generate|finish|fill in)\b"
EXPLANATION_PROMPT = r"\bexplain\s+(what|how|why|the|this|that|following)\b|\bwhat\s+does\b|\bwhat\s+will\s+(be\s+)?(printed|output)\b|\bpredict\s+the\s+output\b|\bunderstand\s+the\s+behavior\b"
OUTPUT_PHRASES = ("predict the output", "what will be printed", "what is the output")
CODE_OUTPUT_TYPES = ("code_generation", "function_completion", "code_repair")


def starts_with_any(c: Column, starts: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, starts)), lambda s: F.startswith(c, s))


def contains_any(c: Column, parts: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, parts)), lambda s: F.contains(c, s))


def features(text: Column) -> Column:
    """A struct of fence, keyword_lines, indented_lines, syntax."""
    lines = T.split_lines(text)
    bare = F.transform(lines, T.strip)
    indented = F.filter(lines, lambda x: x.rlike(r"^(    |\t)") & (T.strip(x) != "") & ~T.strip(x).rlike(r"^[-*]"))
    return F.struct(
        F.contains(text, F.lit("```")).alias("fence"),
        F.size(F.filter(bare, lambda x: starts_with_any(x, KEYWORDS))).alias("keyword_lines"),
        F.size(indented).alias("indented_lines"),
        text.rlike(SYNTAX).alias("syntax"),
    )


def looks_like_code(text: Column, f: Column | None = None) -> Column:
    f = features(text) if f is None else f
    has = lambda s: F.contains(text, F.lit(s))
    return (F.length(T.strip(text)) >= 20) & (
        (f["fence"] & ((f["keyword_lines"] >= 1) | f["syntax"]))
        | (f["keyword_lines"] >= 2)
        | ((f["indented_lines"] >= 2) & f["syntax"])
        | (has("def ") & has("return"))
        | (has("class ") & (has("def ") | has("return")))
    )


def prose_without_code(text: Column) -> Column:
    return starts_with_any(F.lower(T.strip(text)), PROSE_STARTS) & ~looks_like_code(text)


def completion_prompt(prompt: Column) -> Column:
    p = F.lower(prompt)
    return contains_any(p, COMPLETION_PHRASES) | p.rlike(BODY_PROMPT) | p.rlike(ONLY_BODY_PROMPT) | p.rlike(MISSING_PROMPT)


def explanation_prompt(prompt: Column) -> Column:
    p = F.lower(prompt)
    return p.rlike(EXPLANATION_PROMPT) & (~p.rlike(CREATION_PROMPT) | contains_any(p, OUTPUT_PHRASES))


def largest_fence(text: Column) -> Column:
    """The longest fenced block, the first of equals; null if there is none that holds something."""
    blocks = F.filter(F.transform(F.regexp_extract_all(text, F.lit(FENCE), F.lit(1)), T.strip), lambda b: b != "")
    return F.aggregate(blocks, F.lit(None).cast("string"), lambda best, b: F.when(best.isNull() | (F.length(b) > F.length(best)), b).otherwise(best))


def mostly_code(text: Column) -> Column:
    bare = T.strip(text)
    lines = F.filter(F.transform(T.split_lines(bare), T.strip), lambda x: x != "")
    fenced = F.filter(T.split_lines(F.coalesce(largest_fence(bare), F.lit(""))), lambda x: T.strip(x) != "")
    code = F.size(F.filter(lines, lambda x: starts_with_any(F.lower(x), CODE_STARTS + KEYWORDS) | x.rlike(r"[{};]") | x.rlike(r"\w+\s*=\s*[^=]")))
    rest = F.size(lines) - code
    return (bare != "") & (
        F.startswith(bare, F.lit("```"))
        | starts_with_any(F.lower(F.coalesce(F.get(lines, F.lit(0)), F.lit(""))), CODE_STARTS)
        | (F.size(fenced) >= F.greatest(F.lit(3), F.floor(F.size(lines) / 2)))
        | ((code >= 3) & (code >= rest))
    )


def sft_type(prompt: Column, answer: Column) -> Column:
    p = F.lower(prompt)
    return (
        F.when(explanation_prompt(prompt), "code_explanation")
        .when(contains_any(p, ("fix", "debug", "bug")), "code_repair")
        .when(completion_prompt(prompt), "function_completion")
        .when(F.contains(answer, F.lit("```")) | looks_like_code(answer), "code_generation")
        .otherwise("code_other")
    )


def comment_lines(text: Column, mark: Column) -> Column:
    return F.array_join(F.transform(F.split(text, "\n"), lambda x: F.concat(mark, F.lit(" "), x)), "\n")


def splice_docstring(code: Column, doc: Column) -> Column:
    """Code without its first triple-quoted string, if that is (or holds) the documentation up to white space."""
    squeeze = lambda c: T.strip(F.regexp_replace(c, f"{T.SPACE}+", " "))
    out = code
    for q in ("'''", '"""'):
        start = F.instr(code, q)
        rest = F.substr(code, start + 3)
        end = F.instr(rest, q)
        tail = F.substr(rest, end + 3)
        tail = F.when(F.startswith(tail, F.lit("\n")), F.substr(tail, F.lit(2))).otherwise(tail)
        cut = F.concat(T.rstrip(F.concat(T.rstrip(F.substr(code, F.lit(1), F.greatest(start - 1, F.lit(0)))), F.lit("\n"), tail)), F.lit("\n"))
        inside = F.substr(rest, F.lit(1), F.greatest(end - 1, F.lit(0)))
        out = F.when((start > 0) & (end > 0) & (doc != "") & F.contains(squeeze(inside), squeeze(doc)), cut).otherwise(out)
    return out
