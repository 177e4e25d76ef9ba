"""An HTML page and console tables of an evaluation report (the small dict that ``training.evaluate`` returns)."""

from __future__ import annotations

from html import escape
from string import Template

PAGE = Template("""<!DOCTYPE html>
<html lang="en"><head><meta charset="utf-8"><title>$title</title>
<style>body{font-family:sans-serif;margin:2em}table{border-collapse:collapse;margin:1em 0}td,th{border:1px solid #ccc;padding:.3em .6em;text-align:right}.bar{background:#47a;height:.8em}</style>
</head><body><h1>$title</h1>$body</body></html>
""")


def shown(x) -> str:
    return f"{x:.4f}" if isinstance(x, float) else escape(str(x))


def table(rows: list[dict]) -> str:
    if not rows:
        return ""
    head = "".join(f"<th>{escape(str(k))}</th>" for k in rows[0])
    body = "".join("<tr>" + "".join(f"<td>{shown(v)}</td>" for v in r.values()) + "</tr>" for r in rows)
    return f"<table><tr>{head}</tr>{body}</table>"


def bars(rows: list[dict]) -> str:
    return "".join(f"<div>{escape(r['feature'])}: {shown(r['share'])} %<div class='bar' style='width:{max(0.0, min(100.0, r['share'])):.1f}%'></div></div>" for r in rows)


def picture(name: str, curve: list[tuple[float, float]], x: str, y: str) -> str:
    """A curve within the unit square as SVG, its points in the mark-up."""
    line = " ".join(f"{20 + 260 * a:.1f},{280 - 260 * b:.1f}" for a, b in curve)
    return f"<figure><svg width='300' height='310' role='img' aria-label='{escape(name)}'><rect x='20' y='20' width='260' height='260' fill='none' stroke='#ccc'/><polyline points='{line}' fill='none' stroke='#47a' stroke-width='2'/><text x='150' y='300' text-anchor='middle'>{escape(x)}</text><text x='5' y='15'>{escape(y)}</text></svg><figcaption>{escape(name)}</figcaption></figure>"


def html(report: dict, title: str = "Evaluation") -> str:
    m = report["metrics"]
    parts = ["<h2>Metrics</h2>", table([{"metric": k, "value": v} for k, v in m.items()])]
    parts += ["<h2>Confusion</h2>", table([{"": "0", "predicted 0": m["tn"], "predicted 1": m["fp"]}, {"": "1", "predicted 0": m["fn"], "predicted 1": m["tp"]}])]
    if report.get("roc"):
        parts += ["<h2>Curves</h2>", picture("ROC", report["roc"], "false positive rate", "true positive rate"), picture("Precision and recall", report["pr"], "recall", "precision")]
    for name in ("classes", "sweep", "comparison"):
        if report.get(name):
            parts += [f"<h2>{name.capitalize()}</h2>", table(report[name])]
    if report.get("importance"):
        parts += ["<h2>Importance</h2>", bars(report["importance"])]
    return PAGE.substitute(title=escape(title), body="".join(parts))


def console(rows: list[dict]) -> str:
    """Rows as aligned columns of text."""
    if not rows:
        return ""
    cells = [list(rows[0])] + [[f"{v:.4f}" if isinstance(v, float) else str(v) for v in r.values()] for r in rows]
    wide = [max(len(r[i]) for r in cells) for i in range(len(cells[0]))]
    return "\n".join("  ".join(c.ljust(w) for c, w in zip(r, wide, strict=True)) for r in cells)
