"""SQL text for small systems of normal equations."""

from __future__ import annotations


def sql_gram(name: str, source: str, cols: list[str], y: str, keys: list[str] = ()) -> str:
    """CTE with the sums g_i_j of products of [1, cols…, y] per key."""
    terms = ["1.0", *cols, y]
    cells = [
        f"CAST(sum({terms[i]}*{terms[j]}) AS DOUBLE) AS g_{i}_{j}" for i in range(len(terms)) for j in range(i, len(terms))
    ]
    keep = "".join(f"{k}, " for k in keys)
    return f"{name} AS (SELECT {keep}{', '.join(cells)} FROM {source}" + (" GROUP BY ALL)" if keys else ")")


def g(i: int, j: int, prefix: str = "") -> str:
    return f"{prefix}g_{min(i, j)}_{max(i, j)}"


def sql_solve(name: str, source: str, size: int, keys: list[str] = (), alpha: str = "0", inverse: bool = False) -> list[str]:
    """CTEs that solve the leading size × size system of ``source`` for g_i_size.

    The result ``name`` has the source's columns plus b_i (and d_i, the inverse's diagonal).
    ``alpha`` is an expression added to the diagonal except at 0.
    """
    extra = size if inverse else 0
    first = [
        f"{g(i, j)}{f' + {alpha}' if i == j and i > 0 else ''} AS m_{i}_{j}" for i in range(size) for j in range(size)
    ]
    first += [f"{g(i, size)} AS m_{i}_{size}" for i in range(size)]
    first += [f"{1.0 if i == j else 0.0}::DOUBLE AS m_{i}_{size + 1 + j}" for i in range(size) for j in range(extra)]
    out = [f"{name}_0 AS MATERIALIZED (SELECT *, {', '.join(first)} FROM {source})"]
    width = size + 1 + extra
    for s in range(size):
        cells = []
        for i in range(size):
            for j in range(width):
                if i == s:
                    cells.append(f"m_{s}_{j}/m_{s}_{s} AS m_{i}_{j}")
                else:
                    cells.append(f"m_{i}_{j} - m_{i}_{s}*m_{s}_{j}/m_{s}_{s} AS m_{i}_{j}")
        out.append(f"{name}_{s + 1} AS MATERIALIZED (SELECT * REPLACE ({', '.join(cells)}) FROM {name}_{s})")
    cells = [f"m_{i}_{size} AS b_{i}" for i in range(size)]
    cells += [f"m_{i}_{size + 1 + i} AS d_{i}" for i in range(extra)]
    out.append(f"{name} AS MATERIALIZED (SELECT *, {', '.join(cells)} FROM {name}_{size})")
    return out


def sql_mse(size: int, prefix: str = "", coef: str = "") -> str:
    """Mean squared error of coefficients b_i on the sums g_i_j."""
    b = [f"{coef}b_{i}" for i in range(size)] + ["(-1.0)"]
    terms = [f"{b[i]}*{b[j]}*{g(i, j, prefix)}" for i in range(size + 1) for j in range(size + 1)]
    return f"greatest(({' + '.join(terms)})/{g(0, 0, prefix)}, 0)"
