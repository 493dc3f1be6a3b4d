"""The linkage rules applied group by group in plain Python, for comparison
on small panels."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import date


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


def day(text: str) -> date | None:
    try:
        found = date(int(text[:4]), int(text[4:6]), int(text[6:])) if len(text) == 8 else None
        return found if found and found.year <= 2261 else None
    except ValueError:
        return None


def amount(text: str | None) -> float | None:
    try:
        return float(text.replace(" ", "").replace(",", "."))
    except (AttributeError, ValueError):
        return None


def close(a: float | None, b: float | None) -> bool:
    if a is None or b is None:
        return False
    return a == b == 0 or abs(a - b) <= 0.001 * max(abs(a), abs(b)) and (a < 0) == (b < 0)


class Report:
    def __init__(self, **columns):
        self.__dict__.update(columns)
        self.mark, self.claimed, self.is_early = "", False, False
        self.read_dates()

    def read_dates(self):
        parts = self.id.split("-")
        self.dates = "-".join(parts[2:4]) if len(parts) >= 4 else ""
        self.start = day(parts[2]) if len(parts) >= 4 else None
        self.end = day(parts[3]) if len(parts) >= 4 else None


def verdict(loan: Report, other: Report, n_loan: int, n_other: int) -> str | None:
    days = (other.end - loan.end).days if loan.end and other.end else 0
    distance = edit_distance(loan.dates, other.dates)
    if loan.start is None or loan.start != other.start:
        return f"Fuzzy Typo Match (Dist: {distance}). Different start dates." if distance <= 2 else None
    if max(n_loan, n_other) > 1:
        return "Collision: Multiple loans share this start date."
    if 0 < abs(days) < 30:
        return f"Small duration change ({days} days). Possible typo."
    now = "Extended" if days > 0 else "Shortened"
    if days and {loan.mark, now} == {"Extended", "Shortened"}:
        return f"Odd Pattern (Was {loan.mark}, now {now}) + Fuzzy Typo Match." if distance <= 2 else None
    return "auto" if days else None


def link(reports: list[Report], decisions: dict[tuple[str, str], str]):
    """Outcome of each missing loan and the review queue; marks and IDs are
    set on the reports."""
    years = sorted({r.year for r in reports})
    groups = defaultdict(lambda: defaultdict(list))
    alone = []
    for r in sorted(reports, key=lambda r: (r.year, r.pos)):
        if r.muni and r.lender:
            groups[r.muni, r.lender][r.year].append(r)
        else:
            alone.append(r)
    outcomes, queue, exhausted = {}, [], Counter()

    def due(r):
        return r.year != years[-1] and r.matures_on[:4].isdigit() and int(r.matures_on[:4]) > r.year

    def ask(loan, other, reason, previous):
        queue.append((loan.composite_id, other.composite_id, loan.dates, other.dates, previous, reason))

    for r in alone:
        if due(r):
            outcomes[r.year, r.pos] = ("early", None)
            exhausted[r.year] += 1
            r.mark, r.is_early = "Repaid Early", True

    for by_year in groups.values():
        for year, following in zip(years, years[1:]):
            loans, others = by_year[year], by_year[following]
            for r in loans:
                r.read_dates()
            n1, n2 = Counter(r.start for r in loans), Counter(r.start for r in others)
            taken: dict[int, Report] = {}
            before = {r.pos: r.mark for r in loans}
            for loan in filter(due, loans):
                free = [o for o in others if not o.claimed]
                exhausted[year] += not free
                same = [o for o in free if close(amount(loan.agreed), amount(o.agreed))]
                choice, how, waits = None, None, False
                if len(same) == 1:
                    choice, how = same[0], "amount"
                else:
                    for o in free:
                        reason = verdict(loan, o, n1[loan.start], n2[o.start])
                        answer = "Y" if reason == "auto" else decisions.get((loan.composite_id, o.composite_id))
                        if reason and answer is None:
                            ask(loan, o, reason, before[loan.pos])
                            waits = True
                        elif reason and answer == "Y":
                            choice, how = o, "dates" if reason == "auto" else "decision"
                            break
                if choice:
                    choice.claimed = True
                    taken[choice.pos] = loan
                    outcomes[year, loan.pos] = (how, choice.pos)
                elif waits:
                    outcomes[year, loan.pos] = ("pending", None)
                    loan.mark = "PENDING_REVIEW"
                else:
                    outcomes[year, loan.pos] = ("early", None)
                    loan.mark, loan.is_early = "Repaid Early", True
            for o in others:
                if o.pos in taken:
                    loan = taken[o.pos]
                    days = (o.end - loan.end).days if loan.end and o.end else 0
                    o.mark = "Extended" if days > 0 else "Shortened" if days < 0 else o.mark
                    o.id = loan.id

        for year in years:
            for loan in [r for r in by_year[year] if r.is_early]:
                loan.dates = "-".join(loan.id.split("-")[2:4]) if len(loan.id.split("-")) >= 4 else ""
                previous = loan.mark
                for later in [y for y in years if y > year + 1]:
                    skipped, done = later - year - 1, False
                    for o in by_year[later]:
                        if o.claimed or not close(amount(loan.agreed), amount(o.agreed)):
                            continue
                        answer = decisions.get((loan.composite_id, o.composite_id))
                        if answer == "Y":
                            o.claimed, o.id, o.mark = True, loan.id, f"Reporting Gap ({skipped}y)"
                            loan.mark, loan.is_early, done = "", False, True
                            break
                        if answer is None:
                            ask(loan, o, f"Reporting-gap candidate ({skipped} year(s) skipped).", previous)
                            loan.mark, loan.is_early, done = "PENDING_REVIEW", False, None
                    if done is not False:
                        break
    return outcomes, queue, exhausted
