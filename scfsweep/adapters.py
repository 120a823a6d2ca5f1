"""The given TPC-H-like tables read as sweep data, so that every query runs on them at any size.

A block of 40 parts is a run, so runs, and with them all groups, grow with the data. Occupation
shifts are multiples of 1/128: sums of them are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scfsweep.schema import check_job

PARTS_PER_RUN = 40
SEED = "SLAB"

# Spark and DuckDB both read these expressions; {job} is the job's name.
RESULT_EXPRESSIONS = {
    "run_id": "concat('run_', cast(floor(l_partkey / 40) as int))",
    "jobname": (
        "concat('./U_', 2 * (l_suppkey % 7), '_{job}/', case when l_linenumber % 6 = 0 then '' else "
        "concat('U_', 2 * (l_suppkey % 7), '_{job}_', l_linenumber % 6, '/') end, 'SLAB')"
    ),
    "channel_id": "cast(l_partkey % 4 + 1 as int)",
    "spin": "cast(l_orderkey % 2 + 1 as int)",
    "before_scf": "cast(l_quantity as double)",
    "first_scf": "cast(l_quantity + (round(l_tax * 100) + 1) / 128 as double)",
    "last_scf": "cast(l_quantity + (round(l_discount * 100) + 2) / 128 as double)",
    "converged": "l_linestatus = 'F'",
}
ROW_FILTERS = {"u": "l_returnflag <> 'R'", "alpha": "l_returnflag = 'R'"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_results(lineitem: DataFrame, job: str | None, *extra: str) -> DataFrame:
    """Result rows of one job, or with None of both, from (streamed or static) lineitem rows."""
    if job is None:
        told = " ".join(f"when {test} then '{name}'" for name, test in ROW_FILTERS.items())
        formed = {name: e.format(job="<job>") for name, e in RESULT_EXPRESSIONS.items()}
        formed["jobname"] = f"replace({formed['jobname']}, '<job>', case {told} end)"
        rows = lineitem.filter(" or ".join(f"({test})" for test in ROW_FILTERS.values()))
    else:
        formed = {name: e.format(job=check_job(job)) for name, e in RESULT_EXPRESSIONS.items()}
        rows = lineitem.filter(ROW_FILTERS[job])
    return rows.selectExpr(*[f"{e} as {name}" for name, e in formed.items()], *extra)


def results(spark: SparkSession, sf_dir: str, job: str) -> DataFrame:
    return as_results(table(spark, sf_dir, "lineitem"), job)


def all_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both jobs in one scan, the job told by the name alone."""
    return as_results(table(spark, sf_dir, "lineitem"), None)


# Lines of result files, some without their last field, some with a word for a number.
LINE_FAULTS = {"short": "l_orderkey % 89 = 5", "worded": "l_orderkey % 97 = 3"}


def result_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of both jobs' results, faults included."""
    faults = [f"{test} as {name}" for name, test in LINE_FAULTS.items()]
    rows = as_results(table(spark, sf_dir, "lineitem"), None, *faults)
    spin = F.when(F.col("worded"), F.lit("two")).otherwise(F.col("spin").cast("string"))
    fields = ["jobname", "channel_id", spin, "before_scf", "first_scf", "last_scf"]
    line = F.concat_ws(", ", *fields, F.when(~F.col("short"), F.col("converged").cast("string")))
    return rows.select(line.alias("value"))


# Names of perturbed jobs as logs give them, with a U below zero and a fraction.
SIGNED_NAMES = (r"^\./U_(\d+)_u/U_\d+_u_(\d+)/", r"U_-{0}.5_u_{1}/")


def signed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of job u under names of one slash and a signed U."""
    pattern, name = SIGNED_NAMES
    return results(spark, sf_dir, "u").withColumn("jobname", F.regexp_replace("jobname", pattern, name.format("$1", "$2")))


# Of these jobs one spin stands under another spelling of the job's path.
SECOND_SPELLING = "spin = 2 and (contains(jobname, '_u_1/') or contains(jobname, '_u_2/'))"


def respelled_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of job u, some of them named from another folder."""
    name = F.when(F.expr(SECOND_SPELLING), F.concat(F.lit("b"), F.substr("jobname", F.lit(2)))).otherwise(F.col("jobname"))
    return results(spark, sf_dir, "u").withColumn("jobname", name)


def result_stream(spark: SparkSession, sf_dir: str, job: str | None) -> DataFrame:
    """The table's own path as a stream, be it a file or a folder of files.

    It is given as a pattern, since a stream takes a plain path for a folder.
    """
    path = f"{sf_dir}/lineitem.parque[t]"
    stream = spark.readStream.schema(table(spark, sf_dir, "lineitem").schema).parquet(path)
    return as_results(stream, job)


# Run folders of a supplier whose jobs lie apart: equal names but for the job, two increments, and
# some alpha folders that fit no U folder.
PAIR_FOLDERS = {
    "u": "concat('P', l_suppkey, '_u_0_2_12_0.05_', case when l_suppkey % 2 = 0 then '0.10' else '0.05' end, '_0.25_STEPS_5')",
    "alpha": (
        "concat('P', l_suppkey, '_alpha_0_2_', case when l_suppkey % 7 = 3 then 10 else 12 end, '_0.05_', "
        "case when l_suppkey % 2 = 0 then '0.10' else '0.05' end, '_0.25_STEPS_5')"
    ),
}


def paired_results(spark: SparkSession, sf_dir: str, job: str) -> DataFrame:
    """Result rows whose run is the job's own folder of their supplier."""
    rows = as_results(table(spark, sf_dir, "lineitem"), job, f"{PAIR_FOLDERS[job]} as folder")
    return rows.drop("run_id").withColumnRenamed("folder", "run_id")


# Sweep arguments of a supplier: rising, falling, fractional, empty and oversize ranges.
VARIED = {
    "u_start": "case s_suppkey % 5 when 0 then '4' when 1 then '9' else '0' end",
    "u_step": "case s_suppkey % 4 when 0 then '2' when 1 then '3' when 2 then '0' else '1' end",
    "u_end": "case s_suppkey % 6 when 0 then '10000000000' when 1 then '0' else cast(s_suppkey % 9 as string) end",
    "pert_step": "case s_suppkey % 3 when 0 then '0.05' when 1 then '1e-15' else '-0.1' end",
    "pert_end": "case s_suppkey % 3 when 2 then '-0.15' else '0.25' end",
}


def varied_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text arguments that differ from run to run."""
    columns = [f"{e} as {name}" for name, e in VARIED.items()]
    return table(spark, sf_dir, "supplier").selectExpr("concat('run_', s_suppkey) as run_id", f"'{SEED}' as seed", "'u' as job", *columns)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text arguments of two sweeps (u and alpha) per run; their U range goes beyond the results."""
    per_run = table(spark, sf_dir, "part").selectExpr(
        f"concat('run_', cast(floor(p_partkey / {PARTS_PER_RUN}) as int)) as run_id"
    )
    return (
        per_run.distinct()
        .withColumn("seed", F.lit(SEED))
        .withColumn("job", F.explode(F.array(F.lit("U"), F.lit("alpha"))))
        .withColumn("u_end", F.lit("14"))
    )


# Folder names of a supplier's two runs, in both dialects; some are malformed, some do not match.
U_FOLDER = "concat('S', s_suppkey, '_u_0_2_', 8 + 2 * (s_nationkey % 3), '_0.05_0.05_0.25_STEPS_5')"
ALPHA_FOLDER = (
    "concat('S', s_suppkey, case when s_suppkey % 5 = 4 then '_beta' else '_alpha' end, "
    "'_0_2_', 8 + 2 * (s_nationkey % 2), '_0.05_', case when s_suppkey % 3 = 0 then '0.10' else '0.05' end, "
    "'_0.25_STEPS_', case when s_suppkey % 11 = 0 then 'x' else '5' end)"
)


def folder_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(u_folder, alpha_folder) of every supplier."""
    return table(spark, sf_dir, "supplier").selectExpr(
        f"{U_FOLDER} as u_folder", f"{ALPHA_FOLDER} as alpha_folder"
    )


def run_folder_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All folder names, one per row."""
    return folder_requests(spark, sf_dir).select(
        F.explode(F.array("u_folder", "alpha_folder")).alias("folder")
    )


def log_text_lines(spark: SparkSession, sf_dir: str, job: str | None) -> DataFrame:
    """Simulator log lines: each lineitem is an occupation, a shipped one also a finish line."""
    path = "concat('/logs/', run_id, '/', substr(jobname, 3), '.castep')"
    rows = as_results(
        table(spark, sf_dir, "lineitem"),
        job,
        "cast(floor(l_orderkey / 1000) as bigint) as block",
        "struct(l_orderkey, l_linenumber, l_extendedprice) as row",
    )
    def padded(column: str, width: int):
        # longer numbers are never cut
        text = F.col(column).cast("string")
        return F.concat(F.repeat(F.lit(" "), F.greatest(F.lit(width) - F.length(text), F.lit(1))), text)

    numbers = F.concat(padded("channel_id", 12), padded("spin", 12))
    occupation = F.concat(numbers, F.lit(" Total:"), padded("first_scf", 20), F.lit("       Mz:"))
    noise = F.concat(numbers, F.lit(" Charge:"), padded("last_scf", 19))
    finish = F.when(F.col("converged"), F.lit("Finalisation time =     1.00 s"))
    return rows.select(
        F.expr(path).alias("file"),
        "block",
        "row",
        F.explode(F.array(noise, occupation, finish)).alias("line"),
    ).filter(F.col("line").isNotNull())


def cell_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cell text per part: a U block of one to three species and, for some, an alpha block."""
    part = table(spark, sf_dir, "part").selectExpr(
        "concat('/cells/part_', p_partkey, '.cell') as file",
        "p_partkey as key",
        "p_size as size",
        "p_retailprice as price",
    )
    eol = F.when(F.col("key") % 2 == 1, F.lit("\r\n")).otherwise(F.lit("\n"))
    price = F.format_string("%.2f", "price")
    iron = F.concat(F.lit("      Fe  "), F.col("size").cast("string"), F.lit("     d: "), price)
    uranium = F.when(F.col("key") % 3 != 0, F.lit("       U  2  d: 1.25 f: 2.5"))
    oxygen = F.when(F.col("key") % 5 == 0, F.lit("       O  7  p: 0.125"))
    alpha = F.when(
        F.col("key") % 4 == 0,
        F.concat_ws("\n", F.lit("%BLOCK HUBBARD_ALPHA"), F.lit("  Fe 1 d: 0.5"), F.lit("%ENDBLOCK HUBBARD_ALPHA")),
    )
    text = F.concat_ws(
        "\n",
        F.lit("%BLOCK SPECIES_MASS"),
        F.lit("      Fe     55.8470001221"),
        F.lit("%ENDBLOCK SPECIES_MASS"),
        F.lit(""),
        F.lit("%BLOCK HUBBARD_U"),
        F.lit("eV"),
        iron,
        uranium,
        oxygen,
        F.lit("%ENDBLOCK HUBBARD_U"),
        F.lit(""),
        alpha,
        F.lit("QUANTIZATION_AXIS :    0.0000    0.0000    1.0000"),
    )
    return part.select("file", F.replace(text, F.lit("\n"), eol).alias("text"))


def part_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text arguments of both sweeps of a run per part, its U range short."""
    per_part = table(spark, sf_dir, "part").selectExpr("concat('part_', p_partkey) as run_id", f"'{SEED}' as seed", "'4' as u_end")
    return per_part.withColumn("job", F.explode(F.array(F.lit("U"), F.lit("alpha"))))


def run_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, file, text): a part's cell text is its run's cell; every tenth run has none."""
    run = F.regexp_extract("file", r"(part_\d+)", 1)
    return cell_texts(spark, sf_dir).withColumn("run_id", run).filter(~run.endswith("7"))


def param_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A settings text per part."""
    part = table(spark, sf_dir, "part").selectExpr(
        "concat('/params/part_', p_partkey, '.param') as file",
        "p_partkey as key",
        "p_size as size",
        "p_type as type",
    )
    eol = F.when(F.col("key") % 2 == 1, F.lit("\r\n")).otherwise(F.lit("\n"))
    text = F.concat_ws(
        "\n",
        F.lit("task : SinglePoint"),
        F.concat(F.lit("comment : made of "), F.lower("type"), F.lit(": as is")),
        F.when(F.col("key") % 3 == 0, F.lit("continuation : default")),
        F.lit("! a remark : not a setting"),
        F.concat(F.lit("spin :        "), F.col("size").cast("string")),
        F.lit("grid_scale :        2.000000000000000"),
        F.lit("fine_grid_scale :        3.000000000000000"),
        F.lit("elec_energy_tol :   5.000000000000000e-007"),
        F.lit(""),
        F.lit("fix_occupancy : false"),
    )
    return part.select("file", F.replace(text, F.lit("\n"), eol).alias("text"))
