"""Logarithm of the normal distribution function as SQL text.

Spark SQL has no error function. The text below evaluates Cody's rational
approximations of erf and erfc (W. J. Cody, Math. Comp. 23, 1969), whose relative
error is near double precision, with plain arithmetic, so it stays in generated
JVM code. Tails are evaluated as logarithms and never underflow.
"""

from __future__ import annotations

# Published coefficients, highest power first.
ERF_TOP = [1.85777706184603153e-1, 3.16112374387056560, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3]
ERF_BOTTOM = [1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3]
MIDDLE_TOP = [
    2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594, 6.61191906371416295e1,
    2.98635138197400131e2, 8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3,
    1.23033935479799725e3,
]
MIDDLE_BOTTOM = [
    1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3,
    3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3,
]
TAIL_TOP = [
    1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1,
    1.60837851487422766e-2, 6.58749161529837803e-4,
]
TAIL_BOTTOM = [
    1.0, 2.56852019228982242, 1.87295284992346725, 5.27905102951428412e-1, 6.05183413124413191e-2,
    2.33520497626869185e-3,
]
SQRT_HALF = 0.7071067811865476
INV_SQRT_PI = 0.5641895835477563


def _number(value: float) -> str:
    return f"({value:.17e})"


def _polynomial(x: str, coefficients: list[float]) -> str:
    text = _number(coefficients[0])
    for c in coefficients[1:]:
        text = f"({text}*{x}+{_number(c)})"
    return text


def log_normal_cdf(column: str, sign: int = 1) -> str:
    """SQL text for ``ln(Phi(sign * column))``; ``column`` is a plain column name."""
    z = f"({_number(-sign * SQRT_HALF)}*{column})"
    erfc_middle = f"({_polynomial(f'abs{z}', MIDDLE_TOP)}/{_polynomial(f'abs{z}', MIDDLE_BOTTOM)})"
    square = f"({z}*{z})"
    inverse = f"(1e0/{square})"
    erfc_tail = (
        f"(({_number(INV_SQRT_PI)}-{inverse}*{_polynomial(inverse, TAIL_TOP)}"
        f"/{_polynomial(inverse, TAIL_BOTTOM)})/abs{z})"
    )
    erf_small = f"({z}*{_polynomial(square, ERF_TOP)}/{_polynomial(square, ERF_BOTTOM)})"
    return (
        f"CASE WHEN abs{z} <= 0.46875e0 THEN ln(0.5e0*(1e0-{erf_small})) "
        f"WHEN {z} > 4e0 THEN ln(0.5e0*{erfc_tail})-{square} "
        f"WHEN {z} > 0e0 THEN ln(0.5e0*{erfc_middle})-{square} "
        f"WHEN {z} >= -4e0 THEN ln(0.5e0*(2e0-exp(-{square})*{erfc_middle})) "
        f"ELSE ln(0.5e0*(2e0-exp(-{square})*{erfc_tail})) END"
    )
