"""Coupon-abuse alerts: devices on which many accounts take coupons without looking at goods.

An account of a device qualifies in a window when it has a coupon event and no item click.  A device with more than
``min_accounts`` qualifying accounts raises an alert that lists those accounts, their items and their events.

The work is split so that no step depends on how large one device or account is.  Verdicts are two flags per account,
a map-side combinable aggregate straight from the events; events are then fetched for guilty accounts alone.  An alert
is stored in long form, a row for each of its accounts, items and kinds of events with a count, so it has the same form
at every size and no list grows with it.
"""

from math import gcd

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import clock
from .salt import SALT, copied, spread

# The event names of the rule.
COUPON, CLICK = "coupon", "clickItem"

WINDOW_SECONDS = 5 * 60
SLIDE_SECONDS = 10
MIN_ACCOUNTS = 3

_SALTS = 16

# Kinds of rows of an alert.
ACCOUNT, ITEM, EVENT = "account", "item", "event"

_FACT = ("mid", "uid", "evid", "itemid")


def stream_facts(logs, window_seconds=WINDOW_SECONDS, slide_seconds=SLIDE_SECONDS, offset_seconds=0,
                 delay="1 minute", once=()):
    """Event counts per window, device, account, event and item, as one stateful aggregation.

    ``once`` names columns by which a message is known: one that comes again counts no more.  Its copies have one event
    time, so they come while the watermark still lets the first in, or are dropped as late.

    In append mode all counts of a window come out together once the watermark passes its end, so every batch of the
    sink holds whole windows.
    """
    seconds = (f"{n} seconds" for n in (window_seconds, slide_seconds, offset_seconds))
    events = (
        logs.where(F.col("mid").isNotNull())
        .select(*_FACT, F.timestamp_seconds("ts").alias("at"), *once)
        .withWatermark("at", delay)
    )
    if once:
        events = events.dropDuplicatesWithinWatermark(list(once))
    return (
        events
        .groupBy(F.window("at", *seconds).alias("win"), *_FACT)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.unix_seconds("win.end").alias("window_end"), *_FACT, "n")
    )


def _floor(seconds, step, offset):
    """The last multiple of ``step``, counted from ``offset``, that is not after ``seconds``."""
    return seconds - F.pmod(seconds - F.lit(offset), F.lit(step))


def _panes(logs, pane_seconds, offset_seconds):
    """Events with the start of their pane, the largest tumbling window of which every sliding one is made."""
    known = logs.where(F.col("mid").isNotNull() & F.col("ts").isNotNull())
    return known.select(_floor(F.col("ts"), pane_seconds, offset_seconds).alias("pane_start"), *_FACT, F.lit(1).alias("n"))


def _marks(rows, keys, coupon, click):
    """Per account whether it took a coupon and whether it looked at an item."""

    def any_of(event):
        return F.max(F.coalesce(F.col("evid") == event, F.lit(False)))

    return rows.groupBy(*keys).agg(any_of(coupon).alias("took"), any_of(click).alias("looked"))


def _minute(zone):
    return clock.minute_text(clock.local_time("window_end", zone))


def _guilty(marks, min_accounts, zone, minutes_shared):
    """The qualifying accounts of alerting devices: (window_end, mid, uid)."""
    accounts = marks.where(F.col("took") & ~F.col("looked"))
    devices = accounts.groupBy("window_end", "mid").agg(F.count(F.lit(1)).alias("accounts"))
    devices = devices.where(F.col("accounts") > min_accounts).select("window_end", "mid")
    if minutes_shared:
        devices = devices.groupBy("mid", _minute(zone).alias("minute")).agg(F.max("window_end").alias("window_end"))
    # One row per alert on the right: copies are cheap, and the accounts of one device need not meet in one task.
    met = spread(accounts.select("window_end", "mid", "uid"), ["uid"], _SALTS)
    return met.join(copied(devices.select("window_end", "mid"), _SALTS), ["window_end", "mid", SALT]).drop(SALT)


def _evidence(rows, guilty, time):
    """The events of guilty accounts; an unknown account is an account, so ``uid`` compares null-safe.

    The events of one account are spread by their items, as an account may have any number of them.
    """
    f, g = spread(rows, ["itemid", "evid"], _SALTS).alias("f"), copied(guilty, _SALTS).alias("g")
    same = F.col("f.uid").eqNullSafe(F.col("g.uid"))
    for key in ("mid", time, SALT):
        same = same & (F.col(f"f.{key}") == F.col(f"g.{key}"))
    return f.join(g, same).select("g.window_end", *[f"f.{c}" for c in _FACT], "f.n")


def window_alerts(facts, min_accounts=MIN_ACCOUNTS, coupon=COUPON, click=CLICK, zone=clock.SHOP_ZONE,
                  minutes_shared=True):
    """The alerts of the windows in ``facts``, counts per window (see ``stream_facts``), in long form.

    A device has one alert per minute: of the windows that end in the same minute, the last alert stays.  Where no two
    windows can end in one minute, ``minutes_shared`` saves looking for them.
    """
    marks = _marks(facts, ("window_end", "mid", "uid"), coupon, click)
    guilty = _guilty(marks, min_accounts, zone, minutes_shared)
    return _documents(_evidence(facts, guilty, "window_end"), zone)


def batch_alerts(logs, window_seconds=WINDOW_SECONDS, slide_seconds=None, offset_seconds=0,
                 min_accounts=MIN_ACCOUNTS, coupon=COUPON, click=CLICK, zone=clock.SHOP_ZONE):
    """The alerts of stored logs; windows tumble unless a slide is given.

    Windows start ``offset_seconds`` after multiples of the slide since the epoch; see ``pane_alerts`` for those that
    slide.
    """
    slide_seconds = slide_seconds or window_seconds
    panes = _panes(logs, gcd(window_seconds, slide_seconds), offset_seconds)
    if slide_seconds == window_seconds:
        facts = panes.select((F.col("pane_start") + window_seconds).alias("window_end"), *_FACT, "n")
        return window_alerts(facts, min_accounts, coupon, click, zone, slide_seconds < 60)
    return pane_alerts(panes, window_seconds, slide_seconds, offset_seconds, min_accounts, coupon, click, zone)


# Sliding windows over panes. Windows are told apart by their starts, which lie on a grid of slides. ----------------


def open_end(pane_end, window_seconds, slide_seconds, offset_seconds=0):
    """The end of the first window that panes up to ``pane_end`` leave open: what ends before it is settled.

    Windows that share a minute are settled together, so that the last of them is known.
    """
    following = pane_end - (pane_end - window_seconds - offset_seconds) % slide_seconds + slide_seconds
    return following - following % 60 if slide_seconds < 60 else following


def _block(seconds, window):
    """Stretches of time as long as a window; what is no longer than a window lies in two of them at most."""
    return F.floor(seconds / F.lit(window))


def _blocks(first, last, window):
    return F.explode(F.sequence(_block(first, window), _block(last, window))).alias("block")


def _qualified(panes, window, slide, offset, coupon, click, ends):
    """Each account's runs of window starts in which it qualifies: (mid, uid, first, last), no run longer than a window.

    The windows that hold a coupon pane start in the window's length up to it. Those that also hold a click start no
    later than the last click up to the pane, or no earlier than a window before the next click; those from the coupon
    pane before on belong to that one's run.
    """
    account = Window.partitionBy("mid", "uid")
    onward, back = account.orderBy("pane_start"), account.orderBy(F.desc("pane_start"))
    pane, before = F.col("pane_start"), (Window.unboundedPreceding, -1)
    clicked, taken = F.when(F.col("looked"), pane), F.when(F.col("took"), pane)
    known = _marks(panes, ("mid", "uid", "pane_start"), coupon, click).where(F.col("took") | F.col("looked")).select(
        "mid", "uid", "pane_start", "took",
        F.last(clicked, True).over(onward.rowsBetween(Window.unboundedPreceding, 0)).alias("clicked"),
        F.last(taken, True).over(onward.rowsBetween(*before)).alias("taken"),
        F.last(clicked, True).over(back.rowsBetween(*before)).alias("next_click"),
    )
    first = _floor(F.greatest(pane - window, "clicked", "taken"), slide, offset) + slide
    last = _floor(F.least(pane, F.col("next_click") - window), slide, offset)
    if ends is not None:
        # On the grid: the first start whose window ends there or later, the last one whose window ends before.
        least, most = ends
        first = first if least is None else F.greatest(first, _floor(F.lit(least - window - 1), slide, offset) + slide)
        last = F.least(last, _floor(F.lit(most - window - 1), slide, offset))
    runs = known.where("took").select("mid", "uid", first.cast("bigint").alias("first"), last.cast("bigint").alias("last"))
    return runs.where("first <= last")


def _alerting(runs, window, slide, min_accounts, zone):
    """The alerting windows of each device: (mid, window_end, start).

    Runs begin and end; the running sum of both is the number of qualifying accounts. Beginnings and ends at one start
    are added up first, so a device has a row for each start at most, however many accounts it has.
    """
    edges = F.array(
        F.struct(F.col("first").alias("at"), F.lit(1).alias("change")),
        F.struct((F.col("last") + slide).alias("at"), F.lit(-1).alias("change")),
    )
    changes = runs.select("mid", F.explode(edges).alias("edge")).groupBy("mid", "edge.at").agg(F.sum("edge.change").alias("change"))
    order = Window.partitionBy("mid").orderBy("at")
    levels = changes.select(
        "mid", "at", F.sum("change").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("accounts"),
        F.lead("at").over(order).alias("until"),
    )
    starts = F.explode(F.sequence("at", F.col("until") - slide, F.lit(slide).cast("bigint")))
    windows = levels.where(F.col("accounts") > min_accounts).select("mid", starts.alias("start"))
    windows = windows.select("mid", (F.col("start") + window).alias("window_end"))
    if slide < 60:
        windows = windows.groupBy("mid", _minute(zone).alias("minute")).agg(F.max("window_end").alias("window_end"))
    return windows.select("mid", "window_end", (F.col("window_end") - window).alias("start"))


def pane_alerts(panes, window_seconds, slide_seconds, offset_seconds=0, min_accounts=MIN_ACCOUNTS, coupon=COUPON,
                click=CLICK, zone=clock.SHOP_ZONE, ends=None):
    """The alerts of sliding windows over event counts of panes (pane_start and ``stream_facts``' columns).

    Nothing is copied into the windows or panes that hold it. An account's verdicts are runs of windows; an event count
    of a window is the difference of two running counts, taken at the first and the last pane that the window shares with
    the event's kind. ``ends`` (first or None, before) limits the windows by their end.
    """
    window, slide = window_seconds, slide_seconds
    runs = _qualified(panes, window, slide, offset_seconds, coupon, click, ends)
    windows = _alerting(runs, window, slide, min_accounts, zone).withColumn("block", _block(F.col("start"), window))
    spans = runs.select("*", _blocks(F.col("first"), F.col("last"), window))
    guilty = windows.join(spans, ["mid", "block"]).where("start BETWEEN first AND last").select("mid", "uid", "start", "window_end")

    counted = panes.groupBy(*_FACT, "pane_start").agg(F.sum("n").alias("n")).alias("c")
    accounts = guilty.select("mid", "uid").distinct().alias("a")

    def same_account(x, y):
        # An unknown account is an account.
        return (F.col(f"{x}.mid") == F.col(f"{y}.mid")) & F.col(f"{x}.uid").eqNullSafe(F.col(f"{y}.uid"))

    order = Window.partitionBy(*_FACT).orderBy("pane_start")
    running = counted.join(accounts, same_account("c", "a"), "left_semi").select(
        *_FACT, "pane_start", "n", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("total"),
        F.lag("pane_start").over(order).alias("before"), F.lead("pane_start").over(order).alias("after"),
        _block(F.col("pane_start"), window).alias("block"),
    ).alias("r")
    places = guilty.select("*", _blocks(F.col("start"), F.col("window_end") - 1, window)).alias("g")
    first = F.coalesce(F.col("r.before") < F.col("g.start"), F.lit(True))
    last = F.coalesce(F.col("r.after") >= F.col("g.window_end"), F.lit(True))
    inside = (F.col("r.pane_start") >= F.col("g.start")) & (F.col("r.pane_start") < F.col("g.window_end"))
    met = running.join(
        places, same_account("r", "g") & (F.col("r.block") == F.col("g.block")) & inside & (first | last)
    )
    nothing = F.lit(0).cast("bigint")
    count = F.when(last, F.col("total")).otherwise(nothing) - F.when(first, F.col("total") - F.col("n")).otherwise(nothing)
    return _documents(met.select("g.window_end", *[f"r.{c}" for c in _FACT], count.alias("n")), zone)


def _documents(evidence, zone):
    """The long form: each account, item and kind of event of an alert, with the number of its events."""
    entries = F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(column).alias("value"))
        for kind, column in ((ACCOUNT, "uid"), (ITEM, "itemid"), (EVENT, "evid"))
    ])
    counts = (
        evidence.select("window_end", "mid", "n", F.explode(entries).alias("entry"))
        .where(F.col("entry.value").isNotNull())
        .groupBy("window_end", "mid", "entry.kind", "entry.value").agg(F.sum("n").alias("n"))
    )
    minute = _minute(zone)
    return counts.select(
        F.concat_ws(" ", "mid", minute).alias("doc_id"), "mid", minute.alias("minute"), "kind", "value", "n",
        (F.col("window_end") * 1000).alias("ts"),
    )
