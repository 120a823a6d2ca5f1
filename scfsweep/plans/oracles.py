"""Plain SQL for every catalogued query, written for DuckDB over the same tables."""

from __future__ import annotations

from scfsweep.adapters import ALPHA_FOLDER, LINE_FAULTS, PAIR_FOLDERS, RESULT_EXPRESSIONS, ROW_FILTERS, SECOND_SPELLING, SIGNED_NAMES, U_FOLDER, VARIED

_JOBS = ("u", "alpha")


def _results(job: str) -> str:
    columns = ", ".join(f"{e.format(job=job)} AS {name}" for name, e in RESULT_EXPRESSIONS.items())
    return f"SELECT {columns} FROM lineitem WHERE {ROW_FILTERS[job]}"


_PERTURBED = "length(jobname) - length(replace(jobname, '/', '')) = 3"
_CONVERGED_REPEATS = """(SELECT *, row_number() OVER (
    PARTITION BY run_id, jobname, channel_id, spin
    ORDER BY converged DESC, last_scf DESC, first_scf DESC, before_scf DESC) AS nth FROM res_{job})"""


def _inverse(column: str) -> str:
    return f"(CASE WHEN {column} = 0 THEN CAST('infinity' AS DOUBLE) ELSE CAST(1 AS DOUBLE) / {column} END)"


def _chain(job: str, source: str = "res_{job}", where: str = _PERTURBED, add_u: bool = True) -> str:
    """Common table expressions res_*, sums_*, diff_* and rows_* of one job."""
    numerator = "k * CAST(0.05 AS DOUBLE)" + (" + u" if job == "alpha" and add_u else "")
    return f"""
    res_{job} AS ({_results(job)}),
    sums_{job} AS (
      SELECT run_id, jobname, channel_id, coalesce(sum(before_scf), 0) AS s0,
             coalesce(sum(first_scf), 0) AS s1, coalesce(sum(last_scf), 0) AS sf
      FROM {source.format(job=job)} WHERE {where} GROUP BY ALL),
    diff_{job} AS (
      SELECT run_id, jobname, channel_id,
             TRY_CAST(nullif(regexp_extract(jobname, 'U_(\\d+)', 1), '') AS INT) AS u,
             TRY_CAST(nullif(regexp_extract(jobname, '{job}_(\\d+)', 1), '') AS INT) AS k,
             s1 - s0 AS d_first, sf - s0 AS d_last
      FROM sums_{job}),
    slope_{job} AS (
      SELECT *, ({numerator}) * {_inverse("d_first")} AS slope_first,
             ({numerator}) * {_inverse("d_last")} AS slope_last,
             k * CAST(0.05 AS DOUBLE) AS pert
      FROM diff_{job}),
    rows_{job} AS (SELECT *, slope_first - slope_last AS n1_nf FROM slope_{job})"""


_TOTAL = "run_id, channel_id, u, d_first, d_last, slope_first, slope_last, pert, n1_nf"
_BOTH = f"WITH {_chain('u')}, {_chain('alpha')}"
_POSITIONAL = f"""{_BOTH},
    rank_u AS (SELECT run_id, channel_id, dense_rank() OVER (PARTITION BY run_id ORDER BY channel_id) AS pair
               FROM (SELECT DISTINCT run_id, channel_id FROM rows_u)),
    rank_alpha AS (SELECT run_id, channel_id, dense_rank() OVER (PARTITION BY run_id ORDER BY channel_id) AS pair
                   FROM (SELECT DISTINCT run_id, channel_id FROM rows_alpha)),
    pairs AS (SELECT a.run_id, a.pair, a.channel_id AS channel_u, b.channel_id AS channel_alpha
              FROM rank_u a JOIN rank_alpha b ON a.run_id = b.run_id AND a.pair = b.pair),
    num_u AS (SELECT p.run_id, p.channel_u, r.u, r.pert, r.n1_nf,
                row_number() OVER (PARTITION BY r.run_id, r.channel_id ORDER BY u, k, jobname) AS rn
              FROM rows_u r JOIN pairs p ON r.run_id = p.run_id AND r.channel_id = p.channel_u),
    num_alpha AS (SELECT p.run_id, p.channel_u, r.pert, r.n1_nf,
                row_number() OVER (PARTITION BY r.run_id, r.channel_id ORDER BY u, k, jobname) AS rn
              FROM rows_alpha r JOIN pairs p ON r.run_id = p.run_id AND r.channel_id = p.channel_alpha),
    merged AS (SELECT coalesce(a.run_id, b.run_id) AS run_id, coalesce(a.channel_u, b.channel_u) AS channel_id,
                 coalesce(a.rn, b.rn) AS position, a.u, a.pert AS u_pert, a.n1_nf AS n1_nf_u,
                 b.pert AS alpha_pert, b.n1_nf AS n1_nf_alpha
               FROM num_u a FULL JOIN num_alpha b
                 ON a.run_id = b.run_id AND a.channel_u = b.channel_u AND a.rn = b.rn)"""
_BY_KEY = f"""{_BOTH},
    merged AS (SELECT coalesce(a.run_id, b.run_id) AS run_id, coalesce(a.channel_id, b.channel_id) AS channel_id,
                 coalesce(a.u, b.u) AS u, coalesce(a.k, b.k) AS k, 'SLAB' AS seed,
                 a.pert AS u_pert, a.n1_nf AS n1_nf_u, b.pert AS alpha_pert, b.n1_nf AS n1_nf_alpha
               FROM rows_u a FULL JOIN rows_alpha b
                 ON a.run_id = b.run_id AND a.channel_id = b.channel_id AND a.u = b.u AND a.k = b.k)"""


def _exact(x: str) -> str:
    """Mean by whole numbers of two sizes, which add up exactly; large values are added as they are."""
    small, coarse = f"abs({x}) < 16777216", f"floor({x} * 1048576)"
    fine = f"floor(({x} - {coarse} / 1048576) * 1125899906842624 + CAST(0.5 AS DOUBLE))"
    whole = " + ".join(
        f"CAST(coalesce(sum(CASE WHEN {small} THEN CAST({part} AS BIGINT) END), 0) AS DOUBLE) / {size}"
        for part, size in ((coarse, 1048576), (fine, 1125899906842624))
    )
    return f"(CASE WHEN count({x}) > 0 THEN ({whole} + coalesce(sum(CASE WHEN NOT ({small}) THEN {x} END), 0)) / count({x}) END)"


_MEANS = f"""SELECT run_id, channel_id, u, {_exact('n1_nf_u')} AS n1_nf_u, {_exact('n1_nf_alpha')} AS n1_nf_alpha
    FROM merged GROUP BY run_id, channel_id, u"""


def _mean(job: str) -> str:
    return f"""WITH {_chain(job)} SELECT run_id, channel_id, u, {_exact('n1_nf')} AS n1_nf_{job}
    FROM rows_{job} GROUP BY ALL"""


_ALL = f"({_results('u')} UNION ALL {_results('alpha')})"
_FRACTIONS = "regexp_replace(jobname, 'U_([246])_', 'U_0.\\1_', 'g')"
_WRITTEN = "regexp_extract(jobname, 'U_([^_/]*)_[a-z]+(?:_[0-9]+)?/[^/]*$', 1)"


def _renamed(job: str) -> str:
    """The chain of a job whose names have some U replaced by fractions."""
    return _chain(job).replace(f"({_results(job)})", f"(SELECT * REPLACE ({_FRACTIONS} AS jobname) FROM ({_results(job)}))")


def _in_pairs(job: str) -> str:
    """The chain of a job under its pair's run id, with the pair's own increment."""
    rows = f"SELECT * REPLACE ({PAIR_FOLDERS['u']} AS run_id) FROM (SELECT l_suppkey, {_results(job).removeprefix('SELECT ')} AND l_suppkey % 7 <> 3)"
    step = "(CASE WHEN contains(run_id, '_0.10_0.25') THEN CAST(0.1 AS DOUBLE) ELSE CAST(0.05 AS DOUBLE) END)"
    return _chain(job).replace("CAST(0.05 AS DOUBLE)", step).replace(f"({_results(job)})", f"(SELECT * EXCLUDE (l_suppkey) FROM ({rows}))")


_CHANNELS_LEFT = f"""WITH found AS (
      SELECT DISTINCT 'u' AS job, run_id, channel_id FROM ({_results('u')}) WHERE {_PERTURBED}
      UNION SELECT DISTINCT 'alpha', run_id, channel_id FROM ({_results('alpha')})
        WHERE {_PERTURBED} AND channel_id < 4 AND (channel_id > 1 OR right(run_id, 1) < '5')),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY run_id, job ORDER BY channel_id) AS pair FROM found)"""


def _result_oracles() -> dict[str, str]:
    values = "before_scf, first_scf, last_scf"
    spin_sums = f"SELECT run_id, jobname, channel_id, s0, s1, sf FROM sums_"
    return {
        "scan_results": f"SELECT * FROM {_ALL}",
        "perturbed_only": f"SELECT run_id, jobname, channel_id, {values} FROM {_ALL} WHERE {_PERTURBED}",
        "base_only": f"SELECT * FROM {_ALL} WHERE NOT ({_PERTURBED})",
        "merged_fractional_u": f"""WITH {_renamed('u')}, {_renamed('alpha')},
            keyed_u AS (SELECT *, {_WRITTEN} AS w FROM rows_u), keyed_alpha AS (SELECT *, {_WRITTEN} AS w FROM rows_alpha)
            SELECT coalesce(a.run_id, b.run_id) AS run_id, coalesce(a.channel_id, b.channel_id) AS channel_id,
              coalesce(a.u, b.u) AS u, coalesce(a.k, b.k) AS k, 'SLAB' AS seed,
              a.pert AS u_pert, a.n1_nf AS n1_nf_u, b.pert AS alpha_pert, b.n1_nf AS n1_nf_alpha
            FROM keyed_u a FULL JOIN keyed_alpha b
              ON a.run_id = b.run_id AND a.channel_id = b.channel_id AND a.u = b.u AND a.k = b.k AND a.w = b.w""",
        "folder_signed_u": "WITH "
        + _chain("u", where="regexp_matches(jobname, 'U_-?\\d+(\\.\\d+)?_(u|alpha)_\\d+/')")
        .replace(f"({_results('u')})", f"(SELECT * REPLACE (regexp_replace(jobname, '{SIGNED_NAMES[0]}', '{SIGNED_NAMES[1].format(chr(92) + '1', chr(92) + '2')}') AS jobname) FROM ({_results('u')}))")
        .replace("TRY_CAST(nullif(regexp_extract(jobname, 'U_(\\d+)', 1), '') AS INT)", "TRY_CAST(nullif(regexp_extract(jobname, 'U_(-?\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE)")
        + f" SELECT {_TOTAL} FROM rows_u",
        "repeated_responses": "WITH "
        + _chain("u").replace(f"({_results('u')})", f"(SELECT * REPLACE (CASE WHEN {SECOND_SPELLING} THEN concat('b', substr(jobname, 2)) ELSE jobname END AS jobname) FROM ({_results('u')}))")
        + """ SELECT run_id, channel_id, u, k, 'SLAB' AS seed, jobname, pert, n1_nf, spellings FROM
            (SELECT *, count(*) OVER (PARTITION BY run_id, channel_id, u, k) AS spellings FROM rows_u) WHERE spellings > 1""",
        "unread_u_jobs": f"""WITH {_renamed('u')} SELECT DISTINCT run_id, jobname, {_WRITTEN} AS u_text
            FROM rows_u WHERE contains(jobname, 'U_0.')""",
        "cut_channels": f"""{_CHANNELS_LEFT} SELECT run_id, job, channel_id FROM ranked a WHERE NOT EXISTS
            (SELECT 1 FROM ranked b WHERE a.run_id = b.run_id AND a.pair = b.pair AND a.job <> b.job)""",
        "paired_means": f"WITH {_in_pairs('u')}, {_in_pairs('alpha')}, {_BY_KEY.split('rows_alpha AS (SELECT *, slope_first - slope_last AS n1_nf FROM slope_alpha),')[1]} {_MEANS}",
        "dedupe_results": f"""WITH res_alpha AS {_ALL}
            SELECT run_id, jobname, channel_id, spin, {values}, converged
            FROM {_CONVERGED_REPEATS.format(job='alpha')} WHERE nth = 1""",
        "spin_sum": f"{_BOTH} {spin_sums}u UNION ALL {spin_sums}alpha",
        "delta_scf": f"WITH {_chain('u')} SELECT run_id, jobname, channel_id, u, k, d_first, d_last FROM diff_u",
        "response_u": f"WITH {_chain('u')} SELECT {_TOTAL} FROM rows_u",
        "response_alpha": f"WITH {_chain('alpha')} SELECT {_TOTAL} FROM rows_alpha",
        "response_alpha_without_u": f"WITH {_chain('alpha', add_u=False)} SELECT {_TOTAL} FROM rows_alpha",
        "response_converged_deduped": "WITH "
        + _chain("u", source=_CONVERGED_REPEATS, where=f"nth = 1 AND converged AND {_PERTURBED}")
        + f" SELECT {_TOTAL} FROM rows_u",
        "channels": f"SELECT DISTINCT run_id, channel_id FROM {_ALL} WHERE {_PERTURBED}",
        "channel_view": f"""WITH {_chain('u')} SELECT run_id, channel_id, u, pert AS u_pert, n1_nf AS n1_nf_u
            FROM rows_u WHERE channel_id = 2""",
        "alpha_columns": f"""WITH {_chain('alpha')} SELECT run_id, channel_id, pert AS alpha_pert,
            n1_nf AS n1_nf_alpha FROM rows_alpha""",
        "mean_u": _mean("u"),
        "mean_alpha": _mean("alpha"),
        "channel_pairs": f"{_POSITIONAL} SELECT run_id, CAST(pair AS INT) AS pair, channel_u, channel_alpha FROM pairs",
        "merged_positional": f"{_POSITIONAL} SELECT * FROM merged",
        "merged_by_key": f"{_BY_KEY} SELECT * FROM merged",
        "merged_mean": f"{_POSITIONAL} {_MEANS}",
        "merged_mean_by_key": f"{_BY_KEY} {_MEANS}",
        "union_parts": f"{_results('u')} UNION ALL {_results('alpha')}",
    }


_RUN_JOBS = """runs AS (SELECT run_id, job FROM
      (SELECT DISTINCT concat('run_', CAST(floor(p_partkey / 40) AS INT)) AS run_id FROM part),
      (VALUES ('u'), ('alpha')) j(job))"""
_GRID = f"""{_RUN_JOBS},
    exact AS (SELECT run_id, job, CAST(ui AS INT) AS ui, CAST(ki AS INT) AS k,
        CAST(ki AS DECIMAL(9,0)) * CAST('0.05' AS DECIMAL(20,14)) AS sh,
        CASE WHEN job = 'u' THEN ui + CAST('0.00000001' AS DECIMAL(20,14))
             ELSE CAST('0.00000001' AS DECIMAL(20,14)) END AS uv
      FROM runs, range(0, 15, 2) a(ui), range(0, 6) b(ki)),
    exact2 AS (SELECT *, CASE WHEN job = 'u' THEN CAST('0.00000001' AS DECIMAL(20,14))
             ELSE ui + CAST('0.00000001' AS DECIMAL(20,14)) END + sh AS av FROM exact),
    grid AS (SELECT run_id, job, CAST(ui AS DOUBLE) AS u, k, CAST(sh AS DOUBLE) AS shift,
        CAST(uv AS DOUBLE) AS u_value, CAST(av AS DOUBLE) AS alpha_value,
        concat(CAST(CAST(uv AS DECIMAL(24,14)) AS VARCHAR), '0') AS u_text,
        concat(CAST(CAST(av AS DECIMAL(24,14)) AS VARCHAR), '0') AS alpha_text,
        CASE WHEN k = 0 THEN CAST(0.00001 AS DOUBLE) ELSE CAST(0.00001 AS DOUBLE) / 10 END AS tol,
        concat('./U_', ui, '_', job, '/',
               CASE WHEN k = 0 THEN '' ELSE concat('U_', ui, '_', job, '_', k, '/') END, 'SLAB') AS jobname
      FROM exact2)"""
_PLAN = f"""WITH {_GRID}, res AS ({_results('u')} UNION ALL {_results('alpha')}),
    done AS (SELECT DISTINCT run_id, jobname FROM res WHERE converged),
    states AS (SELECT run_id, jobname, bool_or(converged) AS converged, count(*) AS n_rows FROM res GROUP BY ALL),
    covered AS (SELECT g.run_id, g.job, g.u, g.k, g.jobname, s.n_rows,
                  CASE WHEN s.n_rows IS NULL THEN 'missing' WHEN s.converged THEN 'done'
                       ELSE 'not_converged' END AS status
                FROM grid g LEFT JOIN states s ON g.run_id = s.run_id AND g.jobname = s.jobname)"""


_VARIED = f"""WITH given AS (SELECT concat('run_', s_suppkey) AS run_id, {', '.join(f'{e} AS {n}' for n, e in VARIED.items())} FROM supplier),
    typed AS (SELECT run_id, CAST(u_start AS BIGINT) AS u_start, CAST(u_step AS BIGINT) AS u_step,
                CASE WHEN u_end <> '10000000000' THEN CAST(u_end AS BIGINT) END AS u_end, pert_step FROM given),
    judged AS (SELECT *, array_to_string(list_filter([
        CASE WHEN u_end IS NOT NULL AND (u_step = 0 OR (u_end - u_start) * u_step < 0) THEN 'u_step' END,
        CASE WHEN u_end IS NULL THEN 'u_end' END, CASE WHEN pert_step = '1e-15' THEN 'pert_step' END],
        lambda x: x IS NOT NULL), ',') AS rejected FROM typed)"""


def _sweep_oracles() -> dict[str, str]:
    keys = "run_id, job, u, k"
    return {
        "rejected_sweeps": f"{_VARIED} SELECT run_id, rejected FROM judged WHERE rejected <> ''",
        "varied_grid": f"""{_VARIED}, by_u AS (SELECT *, unnest(range(0, CAST((u_end - u_start) // u_step AS BIGINT) + 1)) AS i
              FROM judged WHERE rejected = ''),
            by_k AS (SELECT *, unnest(CASE WHEN pert_step = '0.05' THEN range(0, 6) ELSE range(0, 4) END) AS k FROM by_u)
            SELECT run_id, 'u' AS job, CAST(u_start + i * u_step AS DOUBLE) AS u, CAST(k AS INT) AS k,
              CASE WHEN k = 0 THEN CAST(0 AS DOUBLE)
                   ELSE CAST(0.05 + (k - 1) * CAST(pert_step AS DECIMAL(9,2)) AS DOUBLE) END AS shift
            FROM by_k""",
        "sweep_arguments": """
            WITH given AS (SELECT concat('run_', s_suppkey) AS run_id,
                CASE s_suppkey % 4 WHEN 0 THEN 'u' WHEN 3 THEN NULL ELSE 'alpha' END AS job,
                CASE s_suppkey % 3 WHEN 0 THEN CAST(12 AS DOUBLE) WHEN 1 THEN CAST(4 AS DOUBLE) END AS u_end,
                s_acctbal AS pert_end FROM supplier)
            SELECT run_id, job, u_end, pert_end,
                array_to_string(list_filter([CASE WHEN u_end IS NULL THEN 'u_end' END,
                    CASE WHEN pert_end < 0.05 THEN 'pert_step' END,
                    CASE WHEN job IS NULL THEN 'job' END], lambda x: x IS NOT NULL), ',') AS rejected
            FROM given""",
        "swept_values": f"""WITH {_RUN_JOBS},
            vals AS (SELECT CAST(i AS INT) AS i, CAST(2 * i + CAST('0.00000001' AS DECIMAL(20,14)) AS DOUBLE) AS v
                     FROM range(0, 8) t(i)
                     UNION ALL
                     SELECT CAST(7 + i AS INT), CAST(i * CAST('0.05' AS DECIMAL(20,14))
                            + CAST('0.00000001' AS DECIMAL(20,14)) AS DOUBLE) FROM range(1, 6) t(i))
            SELECT run_id, job, CAST(5 AS INT) AS times, i, v FROM runs, vals""",
        "sweep_grid": f"WITH {_GRID} SELECT {keys}, shift FROM grid",
        "setpoints": f"WITH {_GRID} SELECT {keys}, u_value, alpha_value, u_text, alpha_text FROM grid",
        "tolerances": f"WITH {_GRID} SELECT {keys}, tol, printf('%e', tol) AS tol_text FROM grid",
        "job_paths": f"WITH {_GRID} SELECT {keys}, jobname FROM grid",
        "pending_jobs": f"{_PLAN} SELECT {keys}, jobname FROM grid g ANTI JOIN done USING (run_id, jobname)",
        "done_jobs": f"{_PLAN} SELECT {keys}, jobname FROM grid g SEMI JOIN done USING (run_id, jobname)",
        "coverage": f"{_PLAN} SELECT {keys}, jobname, n_rows, status FROM covered",
        "missing_ranges": f"""{_PLAN} SELECT run_id, job, u, min(k) AS first_k, max(k) AS last_k, count(*) AS n_steps FROM
            (SELECT *, k - row_number() OVER (PARTITION BY run_id, job, u ORDER BY k) AS island FROM covered WHERE status = 'missing')
            GROUP BY run_id, job, u, island""",
        "coverage_summary": f"{_PLAN} SELECT run_id, job, status, count(*) AS n_jobs FROM covered GROUP BY ALL",
    }


_NUMBER = "'^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def _folder_number(place: int) -> str:
    return f"CASE WHEN regexp_matches(p[{place}], {_NUMBER}) THEN TRY_CAST(p[{place}] AS DOUBLE) END"


_FOLDERS = f"""WITH folders AS (SELECT unnest([{U_FOLDER}, {ALPHA_FOLDER}]) AS folder FROM supplier),
    split AS (SELECT folder, string_split(folder, '_') AS p FROM folders),
    parsed AS (SELECT folder, array_to_string(p[1:len(p) - 9], '_') AS seed,
        CASE WHEN p[-9] IN ('u', 'U') THEN 'u' WHEN p[-9] IN ('alpha', 'Alpha') THEN 'alpha' END AS job,
        {_folder_number(-8)} AS init_u, {_folder_number(-7)} AS step_u, {_folder_number(-6)} AS final_u,
        {_folder_number(-5)} AS pert_init, {_folder_number(-4)} AS pert_step, {_folder_number(-3)} AS pert_final,
        TRY_CAST(p[-1] AS BIGINT) AS times FROM split),
    checked AS (SELECT *, array_to_string(list_filter([
        CASE WHEN job IS NULL THEN 'job' END, CASE WHEN init_u IS NULL THEN 'init_u' END,
        CASE WHEN step_u IS NULL THEN 'step_u' END, CASE WHEN final_u IS NULL THEN 'final_u' END,
        CASE WHEN times IS NULL THEN 'times' END], lambda x: x IS NOT NULL), ',') AS missing FROM parsed),
    us AS (SELECT * FROM checked WHERE missing = '' AND job = 'u'),
    alphas AS (SELECT * FROM checked WHERE missing = '' AND job = 'alpha'),
    fits AS (SELECT u.*, a.folder AS alpha_folder,
        row_number() OVER (PARTITION BY u.folder ORDER BY
          (a.pert_init = u.pert_init AND a.pert_final = u.pert_final AND a.times = u.times) DESC,
          a.pert_init, a.pert_final, a.times, a.folder) AS nth
      FROM us u JOIN alphas a USING (seed, init_u, step_u, final_u, pert_step))"""


def _folder_oracles() -> dict[str, str]:
    pair = "seed, init_u, step_u, final_u, pert_step"
    return {
        "run_folders": f"""{_FOLDERS} SELECT folder, seed, job, init_u, step_u, final_u, pert_init, pert_step,
            pert_final, times FROM checked WHERE missing = ''""",
        "rejected_folders": f"{_FOLDERS} SELECT folder, missing FROM checked WHERE missing <> ''",
        "folder_plan": f"""{_FOLDERS},
            us2 AS (SELECT folder, seed, job, CAST(final_u AS INT) AS final_u, times FROM checked WHERE missing = ''),
            by_u AS (SELECT *, unnest(range(0, final_u + 1, 2)) AS ui FROM us2),
            by_k AS (SELECT *, unnest(range(0, times + 1)) AS ki FROM by_u)
            SELECT folder AS run_id, seed, job, CAST(ui AS DOUBLE) AS u, CAST(ki AS INT) AS k,
              concat('./U_', ui, '_', job, '/', CASE WHEN ki = 0 THEN '' ELSE
                     concat('U_', ui, '_', job, '_', ki, '/') END, seed) AS jobname FROM by_k""",
        "run_pairs": f"{_FOLDERS} SELECT {pair}, folder AS u_folder, alpha_folder FROM fits WHERE nth = 1",
        "unpaired_alpha_runs": f"""{_FOLDERS} SELECT folder AS alpha_folder, seed, CASE
              WHEN NOT EXISTS (SELECT 1 FROM us u WHERE u.seed = a.seed AND u.init_u = a.init_u AND u.step_u = a.step_u
                AND u.final_u = a.final_u AND u.pert_step = a.pert_step) THEN 'no U run fits'
              ELSE 'another one was taken' END AS reason
            FROM alphas a WHERE folder NOT IN (SELECT alpha_folder FROM fits WHERE nth = 1)""",
        "unpaired_runs": f"""{_FOLDERS} SELECT folder AS u_folder, seed, CASE
              WHEN NOT EXISTS (SELECT 1 FROM alphas a WHERE a.seed = us.seed) THEN 'no alpha run'
              WHEN NOT EXISTS (SELECT 1 FROM alphas a WHERE a.seed = us.seed AND a.init_u = us.init_u
                AND a.step_u = us.step_u AND a.final_u = us.final_u) THEN 'U range differs'
              ELSE 'perturbation step differs' END AS reason
            FROM us WHERE folder NOT IN (SELECT folder FROM fits)""",
        "check_pairs": f"""SELECT {U_FOLDER} AS u_folder, {ALPHA_FOLDER} AS alpha_folder, CASE
              WHEN s_suppkey % 5 = 4 OR s_suppkey % 11 = 0 THEN 'unreadable name'
              WHEN s_nationkey % 3 <> s_nationkey % 2 THEN 'U range differs'
              WHEN s_suppkey % 3 = 0 THEN 'perturbation step differs' END AS reason FROM supplier""",
    }


def _log_chain(*jobs: str) -> str:
    order = "ORDER BY l_orderkey, l_linenumber, l_extendedprice"
    rows = " UNION ALL ".join(
        "SELECT l_orderkey, l_linenumber, l_extendedprice, " + _results(job).removeprefix("SELECT ") for job in jobs
    )
    return f"""log AS (SELECT *, concat('/logs/', run_id, '/', substr(jobname, 3), '.castep') AS file FROM ({rows})),
    obs AS (SELECT run_id, jobname, file, channel_id AS species, spin, converged, first_scf AS value,
        row_number() OVER (PARTITION BY file, channel_id, spin {order}) AS position FROM log),
    files AS (SELECT file, bool_or(converged) AS converged FROM log GROUP BY file),
    picks AS (SELECT run_id, jobname, file, species, spin,
        max(CASE WHEN position = 1 THEN value END) AS before_scf,
        max(CASE WHEN position = 2 THEN value END) AS first_scf,
        arg_max(value, position) AS last_scf, count(*) AS n_obs
      FROM obs GROUP BY ALL),
    flagged AS (SELECT p.*, f.converged FROM picks p JOIN files f USING (file))"""


def _log_oracles() -> dict[str, str]:
    picked = "file, species, spin, before_scf, first_scf, last_scf, n_obs, converged"
    found = "run_id, jobname, species AS channel_id, spin, before_scf, first_scf, last_scf, converged"
    from_logs = _chain("alpha").replace(f"res_alpha AS ({_results('alpha')})", f"res_alpha AS (SELECT {found} FROM flagged)")
    return {
        "log_observations": f"WITH {_log_chain(*_JOBS)} SELECT file, species, spin, position, value FROM obs",
        "log_converged": f"WITH {_log_chain(*_JOBS)} SELECT file, converged FROM files",
        "log_picks": f"WITH {_log_chain(*_JOBS)} SELECT {picked} FROM flagged",
        "log_complete_series": f"""WITH {_log_chain(*_JOBS)},
            expected AS (SELECT m.file, CAST(unnest(range(1, n + 1)) AS INT) AS species
                         FROM (SELECT file, max(species) AS n FROM picks GROUP BY file) m),
            pairs AS (SELECT file, species, spin FROM expected, (VALUES (1), (2)) s(spin))
            SELECT p.file, p.species, p.spin, before_scf, first_scf, last_scf, coalesce(n_obs, 0) AS n_obs,
                   files.converged
            FROM pairs p LEFT JOIN picks USING (file, species, spin) JOIN files ON p.file = files.file""",
        "log_rows_by_cell": f"""WITH {_log_chain(*_JOBS)},
            counts AS (SELECT concat('run_', p_partkey) AS run_id, 1 + CASE WHEN p_partkey % 3 <> 0 THEN 1 ELSE 0 END
                         + CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS n FROM part),
            known AS (SELECT DISTINCT file, n FROM picks LEFT JOIN counts USING (run_id)),
            pairs AS (SELECT file, CAST(unnest(range(1, n + 1)) AS INT) AS species, CAST(spin AS INT) AS spin
                        FROM known, (VALUES (1), (2)) s(spin) WHERE n IS NOT NULL
                      UNION ALL SELECT p.file, species, spin FROM picks p JOIN known k ON p.file = k.file WHERE n IS NULL)
            SELECT p.file, p.species, p.spin, before_scf, first_scf, last_scf, coalesce(n_obs, 0) AS n_obs, files.converged
            FROM pairs p LEFT JOIN picks USING (file, species, spin) JOIN files ON p.file = files.file""",
        "log_results": f"WITH {_log_chain(*_JOBS)} SELECT {found} FROM flagged",
        "mean_from_logs": f"""WITH {_log_chain('alpha')}, {from_logs}
            SELECT run_id, channel_id, u, {_exact('n1_nf')} AS n1_nf_alpha FROM rows_alpha GROUP BY ALL""",
    }


# Items of the cell texts: block, line, element, atom, orbital, value, on which parts.
_ITEMS = """items AS (
      SELECT p_partkey AS key, 'U' AS block, 1 AS pos, 'Fe' AS element, p_size AS atom_id, 'd' AS orbital,
             round(p_retailprice, 2) AS value FROM part
      UNION ALL SELECT p_partkey, 'U', 2, 'U', 2, 'd', 1.25 FROM part WHERE p_partkey % 3 <> 0
      UNION ALL SELECT p_partkey, 'U', 2, 'U', 2, 'f', 2.5 FROM part WHERE p_partkey % 3 <> 0
      UNION ALL SELECT p_partkey, 'U', CASE WHEN p_partkey % 3 <> 0 THEN 3 ELSE 2 END, 'O', 7, 'p', 0.125
                FROM part WHERE p_partkey % 5 = 0
      UNION ALL SELECT p_partkey, 'ALPHA', 1, 'Fe', 1, 'd', 0.5 FROM part WHERE p_partkey % 4 = 0),
    cells AS (SELECT concat('/cells/part_', key, '.cell') AS file, key, block, CAST(pos AS INT) AS pos,
                element, CAST(atom_id AS INT) AS atom_id, orbital, CAST(value AS DOUBLE) AS value FROM items),
    whole AS (SELECT * FROM cells UNION ALL
              SELECT file, key, 'ALPHA', pos, element, atom_id, orbital, value FROM cells
              WHERE block = 'U' AND key % 4 <> 0)"""
_SETTINGS = """lines AS (
      SELECT p_partkey AS key, 1 AS pos, 'task' AS name, 'SinglePoint' AS value FROM part
      UNION ALL SELECT p_partkey, 2, 'comment', concat('made of ', lower(p_type), ': as is') FROM part
      UNION ALL SELECT p_partkey, 3, 'continuation', 'default' FROM part WHERE p_partkey % 3 = 0
      UNION ALL SELECT p_partkey, 4 + extra, 'spin', CAST(p_size AS VARCHAR) FROM shifted
      UNION ALL SELECT p_partkey, 5 + extra, 'grid_scale', '2.000000000000000' FROM shifted
      UNION ALL SELECT p_partkey, 6 + extra, 'fine_grid_scale', '3.000000000000000' FROM shifted
      UNION ALL SELECT p_partkey, 7 + extra, 'elec_energy_tol', '5.000000000000000e-007' FROM shifted
      UNION ALL SELECT p_partkey, 9 + extra, 'fix_occupancy', 'false' FROM shifted),
    before AS (SELECT key, pos, name, CASE name WHEN 'elec_energy_tol' THEN '1e-5'
                 WHEN 'grid_scale' THEN '1.750000000000000' ELSE value END AS value
               FROM lines WHERE name NOT IN ('continuation', 'fine_grid_scale')),
    perturbed AS (SELECT key, pos, name, CASE name WHEN 'elec_energy_tol' THEN '1.000000e-06' ELSE value END AS value
                  FROM before UNION ALL SELECT p_partkey, 1, 'continuation', 'default' FROM part)"""


_PART_GRID = _GRID.replace(
    _RUN_JOBS, "runs AS (SELECT concat('part_', p_partkey) AS run_id, job FROM part, (VALUES ('u'), ('alpha')) j(job))"
).replace("range(0, 15, 2)", "range(0, 5, 2)")


def _settings_oracles() -> dict[str, str]:
    head = "file, block, pos, element, atom_id, orbital"

    def items(source: str, value: str) -> str:
        return f"WITH {_ITEMS} SELECT {head}, {value} AS value FROM {source}"

    def settings(source: str) -> str:
        return f"""WITH shifted AS (SELECT *, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS extra FROM part),
            {_SETTINGS} SELECT concat('/params/part_', key, '.param') AS file, CAST(pos AS INT) AS pos,
            name AS key, value, TRY_CAST(value AS DOUBLE) AS value_num FROM {source}"""

    return {
        "planned_items": f"""WITH {_PART_GRID}, {_ITEMS}
            SELECT g.run_id, g.jobname, w.block, w.pos, w.element, w.atom_id, w.orbital,
                   CASE WHEN w.block = 'U' THEN g.u_value ELSE g.alpha_value END AS value
            FROM grid g JOIN whole w ON g.run_id = concat('part_', w.key) WHERE w.key % 10 <> 7""",
        "items_without_cell": f"WITH {_PART_GRID} SELECT run_id, jobname, 'no cell' AS cell_status FROM grid WHERE right(run_id, 1) = '7'",
        "species_count": """SELECT concat('/cells/part_', p_partkey, '.cell') AS file,
            CAST(1 + CASE WHEN p_partkey % 3 <> 0 THEN 1 ELSE 0 END
                   + CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS INT) AS n_species FROM part""",
        "block_items": items("cells", "value"),
        "alpha_block": items("whole", "CASE WHEN block = 'ALPHA' THEN CAST(0.125 AS DOUBLE) ELSE value END"),
        "set_values": items("whole", "CASE WHEN block = 'ALPHA' THEN CAST(0.5 AS DOUBLE) ELSE CAST(2 AS DOUBLE) END"),
        "perturbed_items": items("whole", "CASE WHEN block = 'ALPHA' THEN CAST(0.75 AS DOUBLE) ELSE CAST(2 AS DOUBLE) END"),
        "update_where": items("cells", "CASE WHEN element = 'U' THEN CAST(3.25 AS DOUBLE) ELSE value END"),
        "first_block_value": """SELECT concat('/cells/part_', p_partkey, '.cell') AS file,
            round(p_retailprice, 2) AS u_value,
            CASE WHEN p_partkey % 4 = 0 THEN CAST(0.5 AS DOUBLE) END AS alpha_value FROM part""",
        "item_text": f"""WITH {_ITEMS} SELECT file, block, pos,
            concat(lpad(element, 4, ' '), ' ', atom_id, ' ', orbital, ': ',
                   lpad(concat(CAST(CAST(value AS DECIMAL(18,3)) AS VARCHAR), '000000000000'), 20, ' ')) AS line
            FROM cells""",
        "settings_long": settings("lines"),
        "settings_completed": settings(
            """(SELECT * FROM lines
                UNION ALL SELECT p_partkey, 9 + 1, 'continuation', 'default' FROM shifted WHERE extra = 0
                UNION ALL SELECT p_partkey, CASE WHEN extra = 0 THEN 9 + 2 ELSE 10 + 1 END, 'max_scf_cycles', '100' FROM shifted)"""
        ),
        "settings_before": settings("before"),
        "settings_perturbed": settings("perturbed"),
    }


def _output_oracles() -> dict[str, str]:
    unpivoted = f"""{_BY_KEY}, means AS ({_MEANS}),
        points AS (SELECT run_id, channel_id, 'n1-nF_U' AS series, u, n1_nf_u AS y FROM means
                   UNION ALL SELECT run_id, channel_id, 'n1-nF_Alpha', u, n1_nf_alpha FROM means)"""
    alpha = f"WITH {_chain('alpha')}"
    values = "jobname, channel_id, spin, before_scf, first_scf, last_scf, converged"
    return {
        "chart_series_long": f"{unpivoted} SELECT run_id, channel_id, series, u, y FROM points",
        "chart_series_arrays": f"""{unpivoted} SELECT run_id, channel_id, series,
            string_agg(CAST(u AS VARCHAR), ',' ORDER BY u) AS xs,
            string_agg(coalesce(printf('%.4f', y), '-'), ',' ORDER BY u) AS ys
            FROM points GROUP BY run_id, channel_id, series""",
        "write_read_merged": f"{_BY_KEY} {_MEANS}",
        "write_read_channels": f"""{alpha} SELECT run_id, channel_id, u, pert AS alpha_pert, n1_nf AS n1_nf_alpha
            FROM rows_alpha""",
        "write_read_total": f"WITH {_chain('u')} SELECT {_TOTAL} FROM rows_u",
        "results_from_files": f"SELECT * FROM {_ALL}",
        "parts_from_files": f"SELECT * FROM {_ALL}",
        "export_order": f"""WITH {_chain('u')} SELECT run_id, channel_id, u, pert,
            CAST(row_number() OVER (PARTITION BY run_id ORDER BY u, k, channel_id) AS INT) AS position FROM rows_u""",
        "logs_from_files": "WITH "
        + _log_chain(*_JOBS).replace("concat('/logs/', run_id, '/', substr(jobname, 3), '.castep')", "run_id").replace(
            "run_id, jobname, file, species", "run_id, file, species"
        )
        + " SELECT run_id, species, spin, before_scf, first_scf, last_scf, n_obs, converged FROM flagged",
        "append_results": f"SELECT {values} FROM ({_results('u')} UNION ALL {_results('alpha')})",
        "stored_means": f"{_BY_KEY} {_MEANS}",
        "refreshed_means": f"{_mean('alpha')}",
        "append_once": f"SELECT run_id, {values}, 'u' AS batch FROM ({_results('u')}) UNION ALL SELECT run_id, {values}, 'alpha' FROM ({_results('alpha')})",
        "sorted_lines": " UNION ALL ".join(f"SELECT {values} FROM ({_results(job)} AND NOT ({LINE_FAULTS['short']} OR {LINE_FAULTS['worded']}))" for job in _JOBS),
        "quarantined_lines": " UNION ALL ".join(
            f"""SELECT {RESULT_EXPRESSIONS['jobname'].format(job=job)} AS jobname,
            CASE WHEN {LINE_FAULTS['short']} THEN '6 fields' ELSE 'Spin: no integer' END AS reason
            FROM lineitem WHERE {ROW_FILTERS[job]} AND ({LINE_FAULTS['short']} OR {LINE_FAULTS['worded']})"""
            for job in _JOBS
        ),
        "stream_log_picks": _log_oracles()["log_picks"],
        "stream_mean_deltas": _mean("alpha"),
        "stream_append": f"SELECT * FROM {_ALL}",
        "stream_spin_sums": f"{_BOTH} SELECT run_id, jobname, channel_id, s0, s1, sf FROM sums_u UNION ALL SELECT run_id, jobname, channel_id, s0, s1, sf FROM sums_alpha",
        "stream_in_batches": f"""SELECT jobname, channel_id, sum(before_scf) AS s0, sum(first_scf) AS s1, sum(last_scf) AS sf
            FROM {_ALL} WHERE {_PERTURBED} GROUP BY ALL""",
        "stream_deduped_mean": _mean("alpha").replace(
            _chain("alpha"), _chain("alpha", source=_CONVERGED_REPEATS, where=f"nth = 1 AND {_PERTURBED}")
        ),
        "stream_dedupe": f"""WITH res_alpha AS {_ALL}
            SELECT run_id, {values} FROM {_CONVERGED_REPEATS.format(job='alpha')} WHERE nth = 1""",
        "stream_running_mean": _mean("alpha"),
    }


def oracle_sql() -> dict[str, str]:
    return {
        **_result_oracles(),
        **_sweep_oracles(),
        **_folder_oracles(),
        **_log_oracles(),
        **_settings_oracles(),
        **_output_oracles(),
    }
