"""MathML to LaTeX: a recursive tree-to-string rule as an Arrow-batched column."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

from paperloom.functions.udf import text_udf

# LaTeX of operators, accents and fences.
OPERATORS = {
    "×": r"\times", "÷": r"\div", "±": r"\pm", "∓": r"\mp", "·": r"\cdot", "⋅": r"\cdot", "∗": "*", "−": "-", "≤": r"\leq", "≥": r"\geq",
    "≠": r"\neq", "≈": r"\approx", "≡": r"\equiv", "∼": r"\sim", "≃": r"\simeq", "∝": r"\propto", "∞": r"\infty", "∂": r"\partial",
    "∇": r"\nabla", "∑": r"\sum", "∏": r"\prod", "∫": r"\int", "∮": r"\oint", "√": r"\sqrt", "∈": r"\in", "∉": r"\notin", "⊂": r"\subset",
    "⊆": r"\subseteq", "∪": r"\cup", "∩": r"\cap", "→": r"\to", "←": r"\leftarrow", "↔": r"\leftrightarrow", "⇒": r"\Rightarrow",
    "⇔": r"\Leftrightarrow", "∀": r"\forall", "∃": r"\exists", "…": r"\ldots", "⋯": r"\cdots", "′": "'", "≪": r"\ll", "≫": r"\gg",
    "⟨": r"\langle", "⟩": r"\rangle", "‖": r"\|", "∘": r"\circ", "⊗": r"\otimes", "⊕": r"\oplus", "⊥": r"\perp", "∥": r"\parallel",
    "\u2062": "", "\u2061": "", "\u2063": "", "\u2064": "",
}
ACCENTS = {"¯": "bar", "‾": "overline", "^": "hat", "ˆ": "hat", "~": "tilde", "˜": "tilde", "→": "vec", "˙": "dot", "¨": "ddot", "_": "underline"}
GREEK = dict(zip("αβγδεζηθικλμνξπρστυφχψωΓΔΘΛΞΠΣΦΨΩ", (
    "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau upsilon phi chi psi omega "
    "Gamma Delta Theta Lambda Xi Pi Sigma Phi Psi Omega").split()))  # fmt: skip
MAX_DEPTH = 32


def _name(el: ET.Element) -> str:
    return el.tag.rpartition("}")[2] if isinstance(el.tag, str) else ""


def _text(el: ET.Element) -> str:
    return "".join(el.itertext()).strip()


def _group(s: str) -> str:
    return s if len(s) == 1 and s.isalnum() else "{" + s + "}"


def _symbols(s: str) -> str:
    return "".join(rf"\{GREEK[c]} " if c in GREEK else c for c in s)


def _row(el: ET.Element, depth: int) -> str:
    return "".join(convert(c, depth + 1) for c in el)


def convert(el: ET.Element, depth: int = 0) -> str:
    """LaTeX of one MathML element."""
    if depth > MAX_DEPTH:
        return _text(el)
    kids = list(el)
    arg = lambda k: convert(kids[k], depth + 1) if k < len(kids) else ""
    match _name(el):
        case "mi":
            t = _text(el)
            return _symbols(t) if len(t) < 2 or t in GREEK else rf"\mathrm{{{t}}}"
        case "mn":
            return _text(el)
        case "mo":
            t = _text(el)
            return f"{OPERATORS[t]} " if t in OPERATORS and OPERATORS[t][:1] == "\\" else OPERATORS.get(t, t)
        case "mtext" | "ms":
            t = "".join(el.itertext())
            return rf"\text{{{t}}}" if t.strip() else " "
        case "mspace":
            return " "
        case "mphantom":
            return rf"\phantom{{{_row(el, depth)}}}"
        case "mfrac":
            form = "binom" if re.fullmatch(r"0(\.0*)?\w*", el.get("linethickness", "")) else "frac"
            return rf"\{form}{{{arg(0)}}}{{{arg(1)}}}"
        case "msqrt":
            return rf"\sqrt{{{_row(el, depth)}}}"
        case "mroot":
            return rf"\sqrt[{arg(1) or 3}]{{{arg(0)}}}"
        case "msup":
            return f"{arg(0)}^{_group(arg(1))}"
        case "msub":
            return f"{arg(0)}_{_group(arg(1))}"
        case "msubsup":
            return f"{arg(0)}_{_group(arg(1))}^{_group(arg(2))}"
        case "mover":
            mark = _text(kids[1]) if len(kids) > 1 else ""
            return rf"\{ACCENTS[mark]}{{{arg(0)}}}" if mark in ACCENTS else f"{arg(0)}^{_group(arg(1))}"
        case "munder":
            mark = _text(kids[1]) if len(kids) > 1 else ""
            return rf"\underline{{{arg(0)}}}" if mark in ("_", "¯", "‾") else f"{arg(0)}_{_group(arg(1))}"
        case "munderover":
            return f"{arg(0)}_{_group(arg(1))}^{_group(arg(2))}"
        case "mfenced":
            seps = el.get("separators", ",") or ""
            body = (seps[:1] or "").join(convert(c, depth + 1) for c in kids)
            return rf"\left{el.get('open', '(')}{body}\right{el.get('close', ')')}"
        case "mtable":
            rows = [" & ".join(convert(c, depth + 2) for c in r) for r in kids if _name(r) in ("mtr", "mlabeledtr")]
            return r"\begin{matrix}" + r" \\ ".join(rows) + r"\end{matrix}"
        case "maction":
            return arg(0)
        case "annotation" | "annotation-xml":
            return ""
        case "math" | "mrow" | "mstyle" | "mtd" | "mpadded" | "semantics" | "menclose" | "merror":
            return _row(el, depth)
        case _:
            return _text(el)


def mathml_to_latex(fragment: str) -> str:
    """LaTeX of a MathML fragment; text that does not parse comes back trimmed."""
    try:
        root = ET.fromstring(fragment)
    except ET.ParseError:
        return fragment.strip()
    return re.sub(r" {2,}", " ", convert(root)).strip()


mathml_to_latex_col = text_udf(mathml_to_latex)
