"""Queries over video frames."""

from __future__ import annotations

from pairforge.operators import frames as V
from pairforge.plans import fixtures as X

SEGMENTS = 16
MANY = 70  # more frames than some videos have
CROP = (8, 4)


def _listing(spark, sf):
    return V.list_frames(X.frames(spark, sf))


def g1(spark, sf):
    return _listing(spark, sf)


def g2(spark, sf):
    return V.sample_frames(_listing(spark, sf), SEGMENTS)


def g2_repeats(spark, sf):
    return V.sample_frames(_listing(spark, sf), MANY)


def g3(spark, sf):
    return V.capped_frames(_listing(spark, sf), MANY)


def g4(spark, sf):
    return V.stride_plan(V.frame_counts(_listing(spark, sf)), 60)


def g5(spark, sf):
    return V.temporal_crop(_listing(spark, sf), *CROP)


def g5_plan(spark, sf):
    plan = V.temporal_crop_plan(V.frame_counts(_listing(spark, sf)), 60, 2)
    return plan.select("video_id", "n_frames", "start_no", "end_no", "too_short")


QUERIES = {
    "g1_frame_listing": g1,
    "g2_even_sampling": g2,
    "g2_even_sampling_repeats": g2_repeats,
    "g3_capped_sampling": g3,
    "g4_stride_plan": g4,
    "g5_temporal_crop": g5,
    "g5_temporal_crop_plan": g5_plan,
}


def _even(n: int, start: str = "0", stop: str = "n_frames - 1") -> str:
    return f"""CASE WHEN k = {n - 1} THEN {stop}
      ELSE CAST(floor(k * (({stop} - ({start}))::DOUBLE / {n - 1}) + ({start})) AS BIGINT) END"""


def _sampled(n: int, where: str = "true") -> str:
    return f"""points AS (
  SELECT video_id, CAST(k AS INTEGER) AS slot, {_even(n)} AS frame_no
  FROM counts, (SELECT unnest(range(0, {n})) AS k) WHERE {where})"""


def _crop(num: int, interval: int) -> str:
    size = num * interval
    return f"""starts AS (
  SELECT *, ('0x' || substr(md5('crop42|' || video_id), 1, 15))::BIGINT % (greatest(0, n_frames - {size} - 1) + 1) AS start_no
  FROM counts),
crops AS (SELECT *, least(start_no + {size}, n_frames) AS end_no FROM starts)"""


SQL = {
    "g1_frame_listing": f"WITH {X.FRAMES} SELECT video_id, frame_path, frame_no FROM listing",
    "g2_even_sampling": f"""WITH {X.FRAMES}, {_sampled(SEGMENTS)}
SELECT video_id, slot, frame_no, frame_path FROM points JOIN listing USING (video_id, frame_no)""",
    "g2_even_sampling_repeats": f"""WITH {X.FRAMES}, {_sampled(MANY)}
SELECT video_id, slot, frame_no, frame_path FROM points JOIN listing USING (video_id, frame_no)""",
    "g3_capped_sampling": f"""WITH {X.FRAMES}, {_sampled(MANY, f'n_frames >= {MANY}')}
SELECT video_id, slot, frame_no, frame_path FROM points JOIN listing USING (video_id, frame_no)
UNION ALL SELECT video_id, CAST(frame_no AS INTEGER), frame_no, frame_path FROM listing JOIN counts USING (video_id)
WHERE n_frames < {MANY}""",
    "g4_stride_plan": f"""WITH {X.FRAMES}
SELECT video_id, CAST(slot AS INTEGER) AS slot,
       CASE WHEN n_frames <= 60 THEN slot ELSE CAST(floor(slot * (n_frames::DOUBLE / 60)) AS BIGINT) END AS frame_no
FROM (SELECT *, unnest(range(0, least(n_frames, 60))) AS slot FROM counts)""",
    "g5_temporal_crop": f"""WITH {X.FRAMES}, {_crop(*CROP)},
points AS (
  SELECT video_id, CAST(k AS INTEGER) AS slot, {_even(CROP[0], 'start_no', 'end_no - 1')} AS frame_no
  FROM crops, (SELECT unnest(range(0, {CROP[0]})) AS k) WHERE end_no - start_no >= {CROP[0]})
SELECT video_id, slot, frame_no, frame_path FROM points JOIN listing USING (video_id, frame_no)""",
    "g5_temporal_crop_plan": f"""WITH {X.FRAMES}, {_crop(60, 2)}
SELECT video_id, n_frames, start_no, end_no, end_no - start_no < 60 AS too_short FROM crops""",
}
