"""Additive count / sum / sum-of-squares of money amounts that do not depend on task order.

Variance decides ties between sizes, so it must not change with the order in which tasks
add doubles. Every amount becomes a whole number of 1 / (10,000 * 2^20) before it is
summed: ten-thousandths, and a binary fraction of one. Amounts with up to four decimals have
no such fraction and are summed exactly, whatever double stands for them; of others the
fraction keeps about what a double holds. All sums are of whole numbers, so one result comes
out of any partitioning.

The number is cut into four limbs of 20 bits, all of its sign. The sums of the limbs and of their products, by
weight, are plain bigint columns: 18 of them, hash-aggregated in generated code. Products are
summed in two pieces, which is safe for 2^40 rows per group.

The variance takes a pivot near the mean off the sums, digit by digit in bigints, before anything
becomes a double, so nothing cancels in floating point, whatever the size of the group. The result is put
together from the highest digit down.

Amounts beyond 14 trillion, NaN and infinity have no such number. They are kept as doubles, by
count, sum and sum of squares, and join the others' mean and squared distances at the end.

``cut`` prepares rows, ``first`` aggregates them; ``again`` merges the output of ``first`` (or of
``again``), in as many steps as the plan likes; ``with_variance`` appends the result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

_UNITS = 10_000
_BITS = 20
_BASE = 1 << _BITS
_LIMBS = 4
_WEIGHTS = 2 * _LIMBS - 1
_LARGEST = float(1 << 57)  # units that fit into three limbs


def _low(value: Column) -> Column:
    return value.bitwiseAND(_BASE - 1)


def _high(value: Column) -> Column:
    return F.shiftright(value, _BITS)


def _settled(digits: list[Column]) -> list[Column]:
    """The same number with what exceeds 20 bits carried one digit up."""
    return [_low(digits[0]), *[_low(d) + _high(before) for before, d in zip(digits, digits[1:])], _high(digits[-1])]


def _number(digits: list[Column]) -> Column:
    """A double from digits of up to 50 bits, highest first: exact until it fills its 53 bits."""
    value = digits[-1].cast("double")
    for digit in reversed(digits[:-1]):
        value = value * float(_BASE) + digit.cast("double")
    return value


class Moments:
    """Named bundle of the sums of one amount column."""

    def __init__(self, prefix: str = "amount"):
        self.count = f"{prefix}_count"
        self.limbs = [f"{prefix}_limb_{i}" for i in range(_LIMBS)]
        self.sums = [f"{prefix}_sum_{i}" for i in range(_LIMBS)]
        self.low = [f"{prefix}_low_{i}" for i in range(_WEIGHTS)]
        self.high = [f"{prefix}_high_{i}" for i in range(_WEIGHTS)]
        self.far = f"{prefix}_far"
        self.far_count, self.far_sum, self.far_squares = (f"{prefix}_far_{x}" for x in ("count", "sum", "squares"))

    def columns(self, squares: bool = True) -> list[str]:
        own = [self.count, *self.sums, self.far_count, self.far_sum]
        return own + [*self.low, *self.high, self.far_squares] if squares else own

    def cut(self, df: DataFrame, amount: Column, *keep: str) -> DataFrame:
        """``keep`` columns with the limbs of ``amount`` (null for none), as ``first`` needs them."""
        scaled = amount * float(_UNITS)
        whole = F.rint(scaled)
        near = F.abs(whole) < _LARGEST
        fraction = F.when(whole / float(_UNITS) == amount, 0.0).otherwise(F.rint((scaled - whole) * float(_BASE)))
        cut = df.select(
            *keep,
            F.when(near, fraction).cast("bigint").alias(self.limbs[0]),
            F.when(near, F.abs(whole)).cast("bigint").alias("_size"),
            F.when(near, F.signum(whole)).cast("bigint").alias("_sign"),
            F.when(~near, amount).alias(self.far),
        )
        size, sign = F.col("_size"), F.col("_sign")
        upper = [_low(size), _low(_high(size)), _high(_high(size))]
        return cut.select(
            *keep, self.limbs[0], *[(limb * sign).alias(name) for limb, name in zip(upper, self.limbs[1:])], self.far
        )

    def first(self, squares: bool = True) -> list[Column]:
        """Aggregates over rows that ``cut`` made; null amounts count nowhere."""
        limbs = [F.col(name) for name in self.limbs]
        a, b, c, d = limbs
        # By weight; those of odd weight are doubled later.
        products = [a * a, a * b, a * c * 2 + b * b, a * d + b * c, b * d * 2 + c * c, c * d, d * d]
        far = F.col(self.far)
        sums = [
            *[(limb, name) for limb, name in zip(limbs, self.sums)],
            *([(_low(p), name) for p, name in zip(products, self.low)] if squares else []),
            *([(_high(p), name) for p, name in zip(products, self.high)] if squares else []),
        ]
        zero, nothing = F.lit(0).cast("bigint"), F.lit(0.0)
        doubles = [(far, self.far_sum), *([(far * far, self.far_squares)] if squares else [])]
        return [
            (F.count(a) + F.count(far)).alias(self.count),
            F.count(far).alias(self.far_count),
            *[F.coalesce(F.sum(value), zero).alias(name) for value, name in sums],
            *[F.coalesce(F.sum(value), nothing).alias(name) for value, name in doubles],
        ]

    def again(self) -> list[Column]:
        """Aggregates that merge the output of ``first`` (or of ``again``)."""
        return [F.sum(name).alias(name) for name in self.columns()]

    def _near_count(self) -> Column:
        return F.col(self.count) - F.col(self.far_count)

    def _near_total(self) -> Column:
        """Sum of the amounts that have limbs; cents come out as a division of whole numbers."""
        base, units = F.lit(Decimal(_BASE)).cast("decimal(7,0)"), F.col(self.sums[-1]).cast("decimal(38,0)")
        for name in self.sums[-2:0:-1]:
            units = ((units * base).cast("decimal(38,0)") + F.col(name).cast("decimal(20,0)")).cast("decimal(38,0)")
        whole = (units / F.lit(Decimal(_UNITS // 100)).cast("decimal(3,0)")).cast("double") / 100.0
        return whole + F.col(self.sums[0]).cast("double") / float(_BASE) / float(_UNITS)

    def total(self) -> Column:
        return F.when(F.col(self.far_count) == 0, self._near_total()).otherwise(self._near_total() + F.col(self.far_sum))

    def mean(self) -> Column:
        """Mean amount, null without amounts."""
        return F.when(F.col(self.count) > 0, self.total() / F.col(self.count).cast("double"))

    def total_squared(self) -> Column:
        wide = "decimal(38,0)"
        digits = []
        for i, name in enumerate(self.low):
            before = F.col(self.high[i - 1]).cast("decimal(25,0)") * (1 if i % 2 else 2) if i else F.lit(Decimal(0))
            digits.append((F.col(name).cast("decimal(25,0)") * (2 if i % 2 else 1) + before).cast(wide))
        digits.append(F.col(self.high[-1]).cast(wide))
        # Without fractions the two lowest weights are nothing; then 38 digits hold the rest of ordinary sums exactly.
        small = digits[5].cast(wide)
        base = F.lit(Decimal(_BASE)).cast("decimal(7,0)")
        for digit in (digits[4], digits[3], digits[2]):
            small = ((small * base).cast(wide) + digit).cast(wide)
        ordinary = (F.col(self.sums[0]) == 0) & (digits[0] == 0) & (digits[6] == 0) & (digits[7] == 0) & (F.abs(digits[5]) < F.lit(Decimal(10**19)))
        exact = (small / F.lit(Decimal(_UNITS)).cast("decimal(5,0)")).cast("double") / float(_UNITS)
        near = F.when(ordinary, exact).otherwise(_number(digits) / float(_BASE) ** 2 / float(_UNITS) ** 2)
        return F.when(F.col(self.far_count) == 0, near).otherwise(near + F.col(self.far_squares))

    def with_variance(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with the population variance: null without amounts, never negative."""
        keep, zero = [F.col(column) for column in df.columns], F.lit(0).cast("bigint")
        given = {column: F.coalesce(F.col(column), zero) for column in (self.count, self.far_count, *self.sums, *self.low, *self.high)}

        def step(df: DataFrame, **values: list[Column]) -> DataFrame:
            # Generated, not projected: each step becomes a small method of its own, and a filter
            # on the result is not written out in terms of all steps before.
            columns = [value.alias(f"_{prefix}{i}") for prefix, column in values.items() for i, value in enumerate(column)]
            return df.select(*keep, F.inline(F.array(F.struct(*columns))))

        def digits(prefix: str, count: int) -> list[Column]:
            return [F.col(f"_{prefix}{i}") for i in range(count)]

        # Sums as digits of 20 bits: of the limbs, and of the products, whose upper pieces belong one weight higher.
        twice = [2 if j % 2 else 1 for j in range(_WEIGHTS)]
        low = [given[column] * times for column, times in zip(self.low, twice)]
        high = [given[column] * times for column, times in zip(self.high, twice)]
        products = [low[0], *[a + b for a, b in zip(low[1:], high)], high[-1]]
        n, sums = given[self.count] - given[self.far_count], [given[column] for column in self.sums]
        df = step(df, n=[n], s=_settled(_settled(sums)), q=_settled(_settled(products)))
        n, sums, products = F.col("_n0"), digits("s", _LIMBS + 2), digits("q", _WEIGHTS + 3)

        # The pivot, from the mean as a double. Any pivot gives the same variance; a near one loses no digits.
        mean = F.rint(_number(sums) / F.greatest(n, F.lit(1)).cast("double"))
        df = step(df, n=[n], s=_settled(sums), q=_settled(products), mean=[mean])
        n_sums, n_products = _LIMBS + 3, _WEIGHTS + 4
        sums, products = digits("s", n_sums), digits("q", n_products)
        rest, pivot = F.col("_mean0"), []
        for i in reversed(range(1, _LIMBS)):
            top = F.floor(rest / float(_BASE**i))
            pivot.insert(0, top)
            rest = rest - top.cast("double") * float(_BASE**i)
        df = step(df, n=[n], s=sums, q=products, p=[rest.cast("bigint"), *pivot])

        # Sums of distances from the pivot, and q - 2 p s + n p p = q - p (2 s - n p), digit by digit.
        p, few, many = digits("p", _LIMBS), _low(n), _high(n)
        shift = [few * p[0], *[few * x + many * y for x, y in zip(p[1:], p)], many * p[-1]]
        shift += [zero] * (n_sums - len(shift))
        off = _number([x - y for x, y in zip(sums, shift)])
        df = step(df, n=[n], q=products, p=p, t=_settled([x * 2 - y for x, y in zip(sums, shift)]), off=[off])
        t, squares = digits("t", n_sums + 1), []
        for j in range(max(n_products, n_sums + _LIMBS)):
            square = products[j] if j < n_products else zero
            for i in range(_LIMBS):
                if 0 <= j - i < len(t):
                    square = square - p[i] * t[j - i]
            squares.append(square)
        df = step(df, n=[n], m2=[_number(squares)], off=[F.col("_off0")])

        m2, off, count = F.col("_m20"), F.col("_off0"), n.cast("double")
        spread = F.greatest(m2 - off * off / count, F.lit(0.0)) / float(_BASE) ** 2 / float(_UNITS) ** 2
        both, far_n = F.col(self.count).cast("double"), F.col(self.far_count).cast("double")
        far_mean = F.col(self.far_sum) / far_n
        far_spread = F.col(self.far_squares) - F.col(self.far_sum) * far_mean
        apart = far_mean - F.when(n > 0, self._near_total() / count).otherwise(far_mean)
        joined = F.when(n > 0, spread).otherwise(0.0) + far_spread + apart * apart * (count * (far_n / both))
        variance = F.when(
            F.col(self.count) > 0, F.when(F.col(self.far_count) == 0, spread / count).otherwise(joined / both)
        )
        return df.select(*keep, F.inline(F.array(F.struct(variance.alias(name)))))
