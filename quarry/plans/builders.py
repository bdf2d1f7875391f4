"""The seven source → record builders, as DataFrame transformations.

Each builder is ``source DataFrame → records`` (``id`` kept as the order key,
plus ``instruction, input, output`` or ``messages``) and is a single
scan-filter-project stage. ``build`` adds the repeatable shuffle order and the
optional cap; ``build_all`` runs every role into one DataFrame.

Builders are registered by name, so new roles are added with
``register("name", fn)`` and used through ``DataFrame.transform``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import fixed
from ..functions import arrays, chat
from ..functions.docstring import with_docstring_stripped
from ..functions.text import clean
from ..operators import filters, order
from ..sources.jsonl import QUICK, write_jsonl
from ..sources.tables import resolve_uri

INSTRUCTION_COLS = ("instruction", "input", "output")


def _cleaned(df: DataFrame, cols: Iterable[str], keep=("id",)) -> DataFrame:
    return df.select(*keep, *[clean(c).alias(c) for c in cols])


def code_writer(src: DataFrame) -> DataFrame:
    """Instruction triples: clean, require instruction+output, output ≥ 20 chars."""
    df = _cleaned(src, INSTRUCTION_COLS)
    df = filters.require(df, ["instruction", "output"])
    return filters.min_chars(df, "output", fixed.MIN_OUTPUT_CHARS)


def test_generator(src: DataFrame) -> DataFrame:
    """Problems with unit tests: first five tests, blanks dropped, joined."""
    tests_type = src.schema["unit_tests"].dataType
    df = src.select(
        "id",
        clean("question").alias("question"),
        clean("code_ground_truth").alias("truth"),
        F.coalesce(arrays.coerce_tests("unit_tests", tests_type), F.array().cast("array<string>")).alias("tests"),
    )
    df = filters.require(df, ["question", "truth", "tests"])
    df = df.withColumn("kept", arrays.cap_tests(F.col("tests"))).filter(F.size("kept") > 0)
    return df.select(
        "id",
        F.lit(fixed.TEST_GENERATOR_INSTRUCTION).alias("instruction"),
        arrays.sections(fixed.PROBLEM_HEADING, F.col("question"), fixed.IMPLEMENTATION_HEADING, F.col("truth"), fixed.CODE_CLOSE).alias("input"),
        arrays.join_blank_line(F.col("kept")).alias("output"),
    )


def test_generator_fallback(src: DataFrame) -> DataFrame:
    """Problems with a test list: all tests joined by a newline, uncleaned."""
    df = src.select(
        "id",
        clean("text").alias("text"),
        clean("code").alias("code"),
        F.coalesce(F.col("test_list"), F.array().cast("array<string>")).alias("tests"),
    )
    df = filters.require(df, ["text", "code", "tests"])
    return df.select(
        "id",
        F.lit(fixed.TEST_GENERATOR_FALLBACK_INSTRUCTION).alias("instruction"),
        arrays.sections(fixed.TASK_HEADING, F.col("text"), fixed.IMPLEMENTATION_HEADING, F.col("code"), fixed.CODE_CLOSE).alias("input"),
        arrays.join_tests(F.col("tests")).alias("output"),
    )


def static_reviewer(src: DataFrame, keywords: Iterable[str] = fixed.REVIEW_KEYWORDS) -> DataFrame:
    """Chats: ≥ 2 turns, keyword in the first 500 chars of the messages,
    roles normalised, empty messages dropped, still ≥ 2 turns."""
    df = src.select("id", F.coalesce(F.col("messages"), F.array()).alias("messages"))
    df = filters.min_turns(df, "messages")
    df = filters.any_keyword(df, "messages", tuple(keywords))
    df = df.select("id", chat.clean_messages("messages").alias("messages"))
    return filters.min_turns(df, "messages")


def security_auditor(src: DataFrame, langs: Iterable[str] = fixed.SECURITY_LANGS) -> DataFrame:
    """Security pairs: language allow-list, required fields, audit sections."""
    df = filters.lang_in(src, "lang", langs)
    df = _cleaned(df, ("vulnerability", "question", "chosen", "rejected"))
    df = filters.require(df, ["question", "chosen", "rejected"])
    v = F.col("vulnerability")
    return df.select(
        "id",
        F.lit(fixed.SECURITY_INSTRUCTION).alias("instruction"),
        arrays.sections(fixed.VULNERABILITY_HEADING, v, fixed.CODE_TO_AUDIT_HEADING, F.col("rejected"), fixed.CODE_CLOSE).alias("input"),
        arrays.sections(fixed.SECURITY_ANALYSIS_HEADING, v, fixed.SECURE_IMPLEMENTATION_HEADING, F.col("chosen"), fixed.CODE_CLOSE).alias("output"),
    )


def performance_optimizer(
    src: DataFrame,
    groups=(fixed.OPTIMIZATION_KEYWORDS, fixed.OPTIMIZATION_LANG_KEYWORDS),
) -> DataFrame:
    """Chats whose first message has a word of every group; later assistant
    messages (role exactly "assistant") become the output."""
    df = src.select("id", F.coalesce(F.col("messages"), F.array()).alias("messages"))
    df = filters.min_turns(df, "messages")
    df = filters.all_groups_keyword(df, "messages", groups)
    df = df.select(
        "id",
        clean(chat.first_content("messages")).alias("input"),
        chat.later_assistant_parts("messages").alias("parts"),
    ).filter(F.size("parts") > 0)
    return df.select(
        "id",
        F.lit(fixed.OPTIMIZATION_INSTRUCTION).alias("instruction"),
        "input",
        chat.assistant_reply(F.col("parts")).alias("output"),
    )


def docs_generator(src: DataFrame) -> DataFrame:
    """Functions: docstring ≥ 20 chars, code ≤ 5000 chars, docstring removed from the code."""
    df = _cleaned(src, ("code", "docstring"))
    df = filters.require(df, ["code", "docstring"])
    df = filters.min_chars(df, "docstring", fixed.MIN_OUTPUT_CHARS)
    df = filters.max_chars(df, "code", fixed.MAX_CODE_CHARS)
    df = with_docstring_stripped(df, "code", "stripped")
    return df.select(
        "id",
        F.lit(fixed.DOCS_INSTRUCTION).alias("instruction"),
        arrays.sections(fixed.CODE_OPEN, F.col("stripped"), fixed.CODE_CLOSE).alias("input"),
        F.col("docstring").alias("output"),
    )


BUILDERS: dict[str, Callable[..., DataFrame]] = {
    "code_writer": code_writer,
    "test_generator": test_generator,
    "static_reviewer": static_reviewer,
    "security_auditor": security_auditor,
    "performance_optimizer": performance_optimizer,
    "docs_generator": docs_generator,
}


def register(name: str, fn: Callable[..., DataFrame]) -> None:
    BUILDERS[name] = fn


def build(
    records: DataFrame,
    seed: int = fixed.SEED,
    max_samples: int | None = None,
    key: str = "id",
) -> DataFrame:
    """Apply the cap of the shuffle order (None/0 = all rows)."""
    return order.sample_n(records, key, max_samples, seed)


def ordered(records: DataFrame, seed: int = fixed.SEED, key: str = "id") -> DataFrame:
    """Records in shuffle order (a range-partitioned global sort), for writing."""
    return order.shuffle(records, key, seed)


def build_all(
    sources: dict[str, DataFrame],
    roles: Iterable[str] | None = None,
    seed: int = fixed.SEED,
    max_samples: int | None = None,
    options: dict[str, dict] | None = None,
) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Run every role; return (records with a ``role`` column, failures).

    A role whose source is missing or whose plan does not analyse is reported
    in ``failures`` and skipped, like a builder that raises. Instruction roles
    carry ``instruction/input/output``; chat roles carry ``messages``; the
    union fills the other columns with nulls.
    """
    options = options or {}
    frames, failures = [], []
    for role in roles or BUILDERS:
        try:
            src = sources[role]
            recs = BUILDERS[role](src, **options.get(role, {}))
            recs = build(recs, seed, max_samples).withColumn("role", F.lit(role))
            recs.schema  # force analysis so plan errors surface here
            frames.append(recs)
        except Exception as exc:  # noqa: BLE001 - isolate one failing role
            failures.append((role, f"{type(exc).__name__}: {exc}"))
    if not frames:
        raise ValueError(f"no role could be built: {failures}")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out, failures


def build_and_write(
    sources: dict[str, DataFrame],
    root: str,
    roles: Iterable[str] | None = None,
    seed: int = fixed.SEED,
    max_samples: int | None = None,
    options: dict[str, dict] | None = None,
    key: str = "id",
    layout: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
    strict: bool = False,
    compression: str = "none",
    mode: str = "overwrite",
) -> list[tuple[str, int | None, str | None]]:
    """Build and write each role to ``<root>/role=<name>/``; one (role, records, error) a role.

    A role that fails, in its plan or in a task, leaves the others as they are. Each role is a job of its
    own and holds only its own columns. ``layout`` arranges the rows before the write (default: the shuffle
    order without the key). With ``strict`` the first failure is raised: for callers that go on with the files
    and would take those of the other roles for the whole. ``mode`` "append" adds to what a role has.
    """
    status = []
    for role in roles or BUILDERS:
        try:
            recs = build(BUILDERS[role](sources[role], **(options or {}).get(role, {})), seed, max_samples, key)
            rows = layout(recs) if layout else ordered(recs, seed, key).drop(key)
            status.append((role, write_jsonl(rows, f"{root.rstrip('/')}/role={role}", partition_by, compression, mode), None))
        except Exception as exc:  # noqa: BLE001 - one failing role must not stop the others
            if strict:
                raise RuntimeError(f"role {role} could not be written: {type(exc).__name__}: {exc}") from exc
            status.append((role, None, f"{type(exc).__name__}: {exc}"))
    return status


Status = list[tuple[str, int | None, str | None]]


def write_together(
    sources: dict[str, DataFrame],
    root: str,
    roles: Iterable[str] | None = None,
    seed: int = fixed.SEED,
    max_samples: int | None = None,
    options: dict[str, dict] | None = None,
    key: str = "id",
    layout: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
    rehearse: bool = False,
    compression: str = "none",
    strict: bool = False,
    mode: str = "overwrite",
) -> Status:
    """``build_and_write`` in one job: all roles are built, and written to ``<root>/role=<name>/`` by one sink.

    A line has the fields of its role only. The roles' record counts are observed in the same job. A role whose source is
    missing or whose plan does not analyse is reported and left out; where the job itself fails, some role fails in a
    task, and the roles are written one by one to tell which. With ``rehearse`` the rows are
    first built once without a file, so that a row that fails is met before other roles' files are written in vain.
    ``compression`` is that of the files of the one job. ``layout`` arranges the rows, which have ``role`` and
    ``key``, before the write (default: each role in the shuffle order). With ``strict`` a failure of any role, in its
    plan or in a task, is raised instead of told. ``mode`` "append" adds to what is there, and needs ``strict``, as a role's
    failure would leave what it has."""
    if mode != "overwrite" and not strict:
        raise ValueError("only a strict write can add to files")
    wanted = list(roles or BUILDERS)
    try:
        recs, failures = build_all(sources, wanted, seed, max_samples, options)
    except ValueError:  # no role could be built
        if strict:
            raise
        return build_and_write(sources, root, wanted, seed, max_samples, options, key, None, partition_by)
    if strict and failures:
        raise RuntimeError(f"roles could not be built: {failures}")
    failed = dict(failures)
    built = [r for r in wanted if r not in failed]
    chat_cols, text_cols = [c for c in ("messages",) if c in recs.columns], [c for c in INSTRUCTION_COLS if c in recs.columns]
    as_line = lambda cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    line = as_line(text_cols) if text_cols else F.lit(None).cast("string")
    if chat_cols:
        line = F.when(F.col("messages").isNotNull(), as_line(chat_cols)).otherwise(line)
    rows = layout(recs) if layout else recs.withColumn("_order", order.order_hash(key, seed)).orderBy("role", "_order", key)
    obs = Observation("write_together")
    rows = rows.observe(obs, *[F.count_if(F.col("role") == r).alias(f"n{i}") for i, r in enumerate(built)])
    try:
        if rehearse:
            recs.write.format("noop").mode("overwrite").save()
        sink = rows.select("role", *partition_by, line.alias("value")).write.mode(mode).partitionBy("role", *partition_by)
        sink.options(**QUICK).text(resolve_uri(root), compression=compression)
    except Exception:  # noqa: BLE001 - a role fails in a task: which one is told by writing them apart
        if strict:
            raise
        arranged = (lambda r: layout(r.withColumn("role", F.lit(""))).drop("role", key)) if layout else None
        return build_and_write(sources, root, wanted, seed, max_samples, options, key, arranged, partition_by)
    counts = obs.get
    done = {r: (r, int(counts[f"n{i}"]), None) for i, r in enumerate(built)}
    return [done.get(r) or (r, None, failed[r]) for r in wanted]
