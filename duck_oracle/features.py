"""Feature families and encodings restated as DuckDB expressions."""

from __future__ import annotations

from duck_oracle.base import AMT, BILL, PAY, cnt, d, flag, mean, ratio, sgreatest

UTIL = [ratio(b, "LIMIT_BAL", "LIMIT_BAL > 0", "NULL") for b in BILL]
FRAC = [ratio(a, b, f"{b} > 0", "1.0") for a, b in zip(AMT, BILL)]


def _streak() -> str:
    late = [f"COALESCE({p} >= 1, FALSE)" for p in PAY]
    terms = ["0.0"]
    for i in range(6):
        for j in range(i, 6):
            cond = " AND ".join(late[i:j + 1])
            terms.append(f"CASE WHEN {cond} THEN {float(j - i + 1)} ELSE 0.0 END")
    return "GREATEST(" + ", ".join(terms) + ")"


def family(group: str) -> list[tuple[str, str]]:
    if group == "pay":
        return [("PAY_MAX", sgreatest(PAY)), ("PAY_MEAN", mean(PAY)),
                ("PAY_N_LATE", cnt([f"{p} >= 1" for p in PAY])),
                ("PAY_N_DULY", cnt([f"{p} <= 0" for p in PAY])),
                ("PAY_CURR_DELINQ", flag("PAY_0 >= 1")),
                ("PAY_TREND", f"{d('PAY_0')} - {d('PAY_6')}"),
                ("PAY_WORST_STREAK", _streak())]
    if group == "util":
        return [("UTIL_MEAN", mean(UTIL)), ("UTIL_MAX", sgreatest(UTIL)), ("UTIL_LAST", UTIL[0])]
    if group == "payratio":
        cover = [ratio(AMT[t], BILL[t + 1], f"{BILL[t + 1]} > 0", "1.0") for t in range(5)]
        return [("FRAC_BILL_PAID_MEAN", mean(FRAC)), ("COVER_PREV_MEAN", mean(cover)),
                ("N_ZERO_PAY", cnt([f"{a} = 0" for a in AMT])),
                ("N_PAID_FULL", cnt([f"{a} >= {b} AND {b} > 0" for a, b in zip(AMT, BILL)]))]
    if group == "bill":
        m = mean(BILL)
        std = "SQRT(" + mean([f"(({d(b)} - {m}) * ({d(b)} - {m}))" for b in BILL]) + ")"
        return [("BILL_MEAN", m), ("BILL_MAX", sgreatest(BILL)), ("BILL_STD", std),
                ("BILL_TREND", f"{d('BILL_AMT1')} - {d('BILL_AMT6')}"),
                ("REM_CREDIT_LAST", f"{d('LIMIT_BAL')} - {d('BILL_AMT1')}"),
                ("REM_CREDIT_MEAN", f"{d('LIMIT_BAL')} - {m}")]
    if group == "paysem":
        return [("PAY_N_REVOLVING", cnt([f"{p} = 0" for p in PAY])),
                ("PAY_N_PAIDFULL", cnt([f"{p} = -1" for p in PAY])),
                ("PAY_N_NOCONS", cnt([f"{p} = -2" for p in PAY])),
                ("PAY0_GE2", flag("PAY_0 >= 2")), ("PAY0_REVOLVING", flag("PAY_0 = 0")),
                ("PAY0_PAIDFULL", flag("PAY_0 = -1"))]
    if group == "coverx":
        rec = ratio("PAY_AMT1", "BILL_AMT2", "BILL_AMT2 > 0", "1.0")
        old = ratio("PAY_AMT5", "BILL_AMT6", "BILL_AMT6 > 0", "1.0")
        return [("COVER_RECENT", rec), ("COVER_TREND", f"({rec}) - ({old})"),
                ("UTIL_TREND", f"({UTIL[0]}) - ({UTIL[5]})")]
    if group == "utilmonths":
        return [(f"UTIL_{k + 1}", UTIL[k]) for k in range(6)]
    if group == "payamtratio":
        return [(f"PAYR_{k + 1}", FRAC[k]) for k in range(6)]
    if group == "stress":
        return [("STRESS_DELINQ_UTIL", f"{flag('PAY_0 >= 2')} * {UTIL[0]}"),
                ("STRESS_MAXPAY_UTIL", f"{sgreatest(PAY)} * {mean(UTIL)}"),
                ("STRESS_CURR", f"(CASE WHEN PAY_0 < 0 THEN 0.0 ELSE {d('PAY_0')} END) * {UTIL[0]}")]
    if group == "paysem2":
        return [("PAY_RECOVERED", flag(f"{sgreatest(PAY)} >= 1 AND PAY_0 <= 0")),
                ("PAY_NEWLY_LATE", flag("PAY_0 >= 1 AND PAY_2 <= 0")),
                ("PAY_DELINQ_RECENT3", cnt([f"{p} >= 1" for p in PAY[:3]])),
                ("PAY_DELINQ_OLD3", cnt([f"{p} >= 1" for p in PAY[3:]])),
                ("PAY_ESCALATION", f"{d('PAY_0')} - {sgreatest(PAY[1:])}")]
    raise KeyError(group)


def engineered(groups) -> list[tuple[str, str]]:
    out = []
    for g in groups:
        out += family(g)
    return out


FOLDED = {"EDUCATION": "CASE WHEN EDUCATION IN (0, 5, 6) THEN 4 ELSE EDUCATION END",
          "MARRIAGE": "CASE WHEN MARRIAGE = 0 THEN 3 ELSE MARRIAGE END"}


def folded_cols() -> str:
    """SELECT list of the panel with codes folded (B1)."""
    from duck_oracle.base import FEATURES
    cols = ["ID"] + [f"{FOLDED[c]} AS {c}" if c in FOLDED else c for c in FEATURES] + ["label"]
    return ", ".join(cols)


def encoding_exprs(enc: dict) -> tuple[dict, list[tuple[str, str]]]:
    """Rewritten column exprs and appended flag exprs of an encoding spec."""
    from duck_oracle.base import FEATURES
    ex = {c: c for c in FEATURES}
    extra = []
    if enc.get("pay_remap"):
        for p in PAY:
            ex[p] = f"(CASE WHEN {p} < 0 THEN 0 ELSE {p} END)"
    if enc.get("pay_flags"):
        extra += [(f"IS_DELINQ_{p}", flag(f"{ex[p]} >= 1")) for p in PAY]
    bn = enc.get("bill_neg", "keep")
    if bn == "clip":
        for b in BILL:
            ex[b] = f"(CASE WHEN {b} < 0 THEN 0.0 ELSE {d(b)} END)"
    elif bn == "flag":
        extra += [(f"OVERPAY_{b}", flag(f"{b} < 0")) for b in BILL]
    if enc.get("log1p"):
        for c in ["LIMIT_BAL"] + BILL + AMT:
            ex[c] = f"(SIGN({d(ex[c])}) * LN(1 + ABS({d(ex[c])})))"
    return ex, extra
