"""DuckDB twins of the linear and logistic fits: sums of products by aggregates, small systems by
Gauss-Jordan steps, Newton steps one CTE after the other."""

from __future__ import annotations

from typing import Sequence


def gram(name: str, src: str, feats: Sequence[str], y: str, by: str | None = None) -> str:
    """CTE of centred sums: a{i}_{j}, b{i}, means m{i} and my, n, sst."""
    cols = [f"avg({y}) AS my", "count(*)::DOUBLE AS n", f"var_pop({y}) * count(*) AS sst"]
    cols += [f"avg({f}) AS m{i}" for i, f in enumerate(feats)]
    cols += [f"covar_pop({f}, {y}) * count(*) AS b{i}" for i, f in enumerate(feats)]
    cols += [f"covar_pop({f}, {g}) * count(*) AS a{i}_{j}" for i, f in enumerate(feats) for j, g in enumerate(feats)]
    return f"{name} AS (SELECT {by + ', ' if by else ''}{', '.join(cols)} FROM {src}{' GROUP BY ' + by if by else ''})"


def solved(name: str, src: str, k: int, keep: Sequence[str], ridge: str = "0.0") -> str:
    """CTEs that solve (a + ridge I) x = b; the last, ``name``, has b0.. as the solution and the columns ``keep``."""
    keep = ", ".join([""] + list(keep))
    cols = [f"a{i}_{j}{f' + {ridge}' if i == j else ''} AS a{i}_{j}" for i in range(k) for j in range(k)] + [f"b{i}" for i in range(k)]
    out, at = [f"{name}_s AS (SELECT {', '.join(cols)}{keep} FROM {src})"], f"{name}_s"
    for p in range(k):
        cols = []
        for i in range(k):
            part = "" if i == p else f" * a{i}_{p}"
            for j in range(p + 1, k):
                cols.append(f"a{p}_{j} / a{p}_{p} AS a{p}_{j}" if i == p else f"a{i}_{j} - a{p}_{j} / a{p}_{p}{part} AS a{i}_{j}")
            cols.append(f"b{p} / a{p}_{p} AS b{p}" if i == p else f"b{i} - b{p} / a{p}_{p}{part} AS b{i}")
        new = name if p == k - 1 else f"{name}_{p}"
        out.append(f"{new} AS (SELECT {', '.join(cols)}{keep} FROM {at})")
        at = new
    return ",\n".join(out)


def intercept(k: int) -> str:
    return "my" + "".join(f" - m{i} * b{i}" for i in range(k))


def coefficient_rows(src: str, feats: Sequence[str], start: int = 0, free: str | None = None) -> str:
    """(feature, coefficient, importance) with the intercept last."""
    rows = [f"SELECT '{f}' AS feature, b{i + start} AS coefficient, abs(b{i + start}) AS importance FROM {src}" for i, f in enumerate(feats)]
    rows.append(f"SELECT '__intercept__', {free or intercept(len(feats))}, NULL::DOUBLE FROM {src}")
    return " UNION ALL ".join(rows)


def elastic_net(name: str, src: str, k: int, l1: float, l2: float, steps: int = 300) -> str:
    """Recursive CTE: coordinate descent on the Gram sums of ``src``; ``name`` has b0.. and the means."""
    def step(j: int) -> str:
        rho = f"b{j} / n" + "".join(f" - a{j}_{i} / n * w{i}" for i in range(k) if i != j)
        return f"sign({rho}) * greatest(abs({rho}) - {l1}, 0) / (a{j}_{j} / n + {l2})"
    body = "SELECT * FROM {n}_r".format(n=name)
    for j in range(k):
        body = f"SELECT * REPLACE ({step(j)} AS w{j}) FROM ({body})"
    rec = f"{name}_r AS (SELECT 0 AS step, {', '.join(f'0.0::DOUBLE AS w{i}' for i in range(k))}, g.* FROM {src} g UNION ALL SELECT * REPLACE (step + 1 AS step) FROM ({body}) WHERE step < {steps})"
    return rec + f",\n{name} AS (SELECT {', '.join(f'w{i} AS b{i}' for i in range(k))}, my, {', '.join(f'm{i}' for i in range(k))} FROM {name}_r WHERE step = {steps})"


def logistic(name: str, src: str, feats: Sequence[str], y: str, l2: float = 0.0, steps: int = 9) -> str:
    """Newton steps from zero; ``name`` has b0 (intercept), b1.. ."""
    x = ["1.0::DOUBLE", *feats]
    k, out, at = len(x), [f"{name}_w0 AS (SELECT {', '.join(f'0.0::DOUBLE AS w{i}' for i in range(len(x)))})"], f"{name}_w0"
    for s in range(1, steps + 1):
        z = " + ".join(f"w{i} * {f}" for i, f in enumerate(x))
        rows = f"SELECT *, 1 / (1 + exp(-({z}))) AS p_ FROM {src}, {at}"
        pen = lambda i, e: f" + {l2} * {e}" if i and l2 else ""
        cols = [f"sum(p_ * (1 - p_) * {x[i]} * {x[j]}){pen(i, '1') if i == j else ''} AS a{i}_{j}" for i in range(k) for j in range(k)]
        cols += [f"sum(({y} - p_) * {x[i]}){pen(i, f'-any_value(w{i})')} AS b{i}" for i in range(k)]
        cols += [f"any_value(w{i}) AS w{i}" for i in range(k)]
        out.append(f"{name}_g{s} AS (SELECT {', '.join(cols)} FROM ({rows}))")
        out.append(solved(f"{name}_d{s}", f"{name}_g{s}", k, [f"w{i}" for i in range(k)]))
        at = f"{name}_w{s}"
        out.append(f"{at} AS MATERIALIZED (SELECT {', '.join(f'w{i} + b{i} AS w{i}' for i in range(k))} FROM {name}_d{s})")
    out.append(f"{name} AS (SELECT {', '.join(f'w{i} AS b{i}' for i in range(k))} FROM {at})")
    return ",\n".join(out)
