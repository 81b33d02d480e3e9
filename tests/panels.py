"""Price panels and altered runs for the tests."""

import datetime as dt

import numpy as np

PANEL = "ticker string, trade_date date, adj_close double"


def business_days(start, n):
    days, day = [], dt.date.fromisoformat(start)
    while len(days) < n:
        if day.weekday() < 5:
            days.append(day)
        day += dt.timedelta(days=1)
    return days


def name_of(i):
    """AAX, ABX, .."""
    return f"{chr(65 + i // 26)}{chr(65 + i % 26)}X"


def waves(n):
    """A market that swings with three unrelated periods and drifts up a little."""
    k = np.arange(n)
    return 3e-4 + 8e-3 * np.sin(1.7 * k) + 3e-3 * np.sin(0.37 * k + 1) + 2e-3 * np.sin(0.053 * k)


def swinging_panel(slopes, n_days=900, wobble=0.0, start="2019-03-01", shift=0, names=name_of):
    """Rows of a panel: every ticker moves by its slope times the market wave, plus a sawtooth of its
    own of height ``wobble``. The first day has no move. Without wobble the equal-weight market is
    the mean slope times the wave."""
    days, wave = business_days(start, n_days), waves(n_days + 1).tolist()
    rows = []
    for i, slope in enumerate(map(float, slopes)):
        price = 20.0 * (i + 1)
        for k, day in enumerate(days):
            if k:
                own = ((31 * k + 17 * (i + shift) + k * k % 7) % 23 - 11) / 11
                price *= 1 + slope * wave[k] + wobble * own
            rows.append((names(i), day, price))
    return rows


class Copy:
    """Tables of a run with some of them replaced."""

    def __init__(self, base, **replaced):
        self._base = base
        self.__dict__.update(replaced)

    def __getattr__(self, name):
        return getattr(self._base, name)
