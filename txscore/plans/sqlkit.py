"""SQL text fragments for the oracle side, mirroring the Column helpers."""

from __future__ import annotations


def ratio(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0.0), 0.0)"


def r6(expr: str, digits: int = 6) -> str:
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


def rates(tn="tn", fp="fp", fn="fn", tp="tp") -> dict[str, str]:
    d = lambda c: f"CAST({c} AS DOUBLE)"
    tn, fp, fn, tp = d(tn), d(fp), d(fn), d(tp)
    n = f"({tn} + {fp} + {fn} + {tp})"
    spec = ratio(tn, f"{tn} + {fp}")
    prec = ratio(tp, f"{tp} + {fp}")
    rec = ratio(tp, f"{tp} + {fn}")
    f1 = ratio(f"2.0 * {tp}", f"2.0 * {tp} + {fp} + {fn}")
    prec0 = ratio(tn, f"{tn} + {fn}")
    f1_0 = ratio(f"2.0 * {tn}", f"2.0 * {tn} + {fn} + {fp}")
    s0, s1 = f"({tn} + {fp})", f"({fn} + {tp})"
    return {
        "accuracy": ratio(f"{tn} + {tp}", n),
        "specificity": spec,
        "precision": prec,
        "recall": rec,
        "f1": f1,
        "precision_weighted": ratio(f"{s0} * {prec0} + {s1} * {prec}", n),
        "recall_weighted": ratio(f"{s0} * {spec} + {s1} * {rec}", n),
        "f1_weighted": ratio(f"{s0} * {f1_0} + {s1} * {f1}", n),
        "balanced_accuracy": f"(({spec}) + ({rec})) / 2.0",
    }
