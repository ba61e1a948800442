"""DuckDB twins of the derived tables, as common table expressions."""

from __future__ import annotations

_CATEGORY = "(['car','truck','bus','van'])[obj_no % 4 + 1]"

_CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def _define(name: str, needs: tuple[str, ...], body: str) -> None:
    _CTE[name] = (needs, body)


_define("obs", (), """
  SELECT printf('scene-%05d', scene_no) AS scene_name,
         printf('w%06d', frame_index // 5 * 5) AS window_id,
         CAST(frame_index AS INT) AS frame_index, CAST(cam AS VARCHAR) AS camera_id,
         printf('obj-%06d', obj_no) AS obj_id,
         printf('inst-%06d', obj_no // 2) AS instance_token,
         q * 6 AS area_pixels, CAST(1 + sk % 4 AS INT) AS visibility_level, q >= 25 AS usable,
         obj_no, pk, sk, n, q, d, t, r
  FROM (SELECT l_orderkey // 60 AS scene_no, (l_orderkey % 60) // 6 AS frame_index,
               (l_linenumber - 1) % 6 AS cam, l_orderkey // 60 * 6 + l_suppkey % 6 AS obj_no,
               min(l_partkey) AS pk, max(l_suppkey) AS sk, count(*) AS n,
               max(CAST(l_quantity AS INT)) AS q, max(CAST(round(l_discount * 100) AS INT)) AS d,
               max(CAST(round(l_tax * 100) AS INT)) AS t,
               max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r
        FROM lineitem GROUP BY 1, 2, 3, 4)""")

_define("assets", ("obs",), f"""
  SELECT printf('a%011d', obj_no) AS asset_id, printf('obj-%06d', obj_no) AS obj_id,
         printf('inst-%06d', obj_no // 2) AS instance_token, {_CATEGORY} AS category,
         printf('assets/%06d.ply', obj_no) AS ply_path,
         sha256('ply|' || obj_no) AS ply_sha256, obj_no, least
  FROM (SELECT obj_no, max(q) AS q, min(q) AS least FROM obs GROUP BY 1) WHERE q >= 46""")

_define("observations", ("obs",), """
  SELECT scene_name, window_id, frame_index, obj_id, instance_token, obj_no,
         max(area_pixels) AS area_pixels, max(visibility_level) AS visibility_level,
         list(camera_id ORDER BY camera_id) AS cameras
  FROM obs GROUP BY ALL""")

_define("records", ("obs",), """
  SELECT * FROM (
    WITH o AS (SELECT *, CASE WHEN r = 1 THEN obj_id ELSE printf('uid-%06d', obj_no) END AS named,
                      scene_name || '|' || frame_index || '|' || camera_id AS loc,
                      scene_name || '__' || printf('f%03d', frame_index) || '__' AS head FROM obs),
    single AS (
      SELECT head || obj_id || '__c' || camera_id AS sample_id, scene_name, frame_index, camera_id,
             [named] AS assets, [obj_id] AS selected,
             sha256('gt|' || loc || '|' || CASE WHEN d = 10 AND q > 40 THEN '1' ELSE '0' END) AS gt,
             sha256('in|' || loc || '|' || obj_id) AS input, sha256('tg|' || loc) AS target,
             pk, sk, n, q, d, t
      FROM o WHERE t < 8)
    SELECT * FROM single
    UNION ALL
    SELECT * REPLACE (sample_id || '__b' AS sample_id, sha256(input || 'b') AS input)
    FROM single WHERE n > 1 AND d = 10
    UNION ALL
    SELECT a.head || 'cmb-' || substr(sha256('["' || a.obj_id || '","' || b.obj_id || '"]'), 1, 12)
             || '__c' || a.camera_id, a.scene_name, a.frame_index, a.camera_id,
           [a.named, b.named], [a.obj_id, b.obj_id], sha256('gt|' || a.loc || '|0'),
           sha256('in|' || a.loc || '|' || a.obj_id || '|' || b.obj_id), sha256('tg|' || a.loc),
           a.pk, a.sk, a.n, a.q, a.d, a.t
    FROM o a JOIN o b ON a.scene_name = b.scene_name AND a.frame_index = b.frame_index
      AND a.camera_id = b.camera_id AND a.instance_token < b.instance_token AND a.t + b.t <= 12)""")

_define("layers", ("obs",), """
  SELECT scene_name || '__' || printf('f%03d', frame_index) || '__c' || camera_id AS sample_id,
         scene_name, frame_index, camera_id, obj_id, obj_no, pk, sk, q, d, t,
         CASE WHEN q > 2 THEN instance_token END AS instance_token,
         CASE WHEN d > 0 THEN sha256(obj_id) ELSE 'short' END AS asset_sha256,
         CASE WHEN t > 0 THEN '+X' ELSE '+Y' END AS forward_axis,
         CASE WHEN pk % 71 = 0 THEN 0.0 ELSE 1.5 END AS dim_h,
         q <> 7 AS exact_identity_verified, q <> 8 AS official_dimensions_applied,
         q <> 9 AS canonical_orientation_applied, q <> 10 AS bottom_ground_locked,
         (pk % 60) / 2.0::DOUBLE AS median_depth_m,
         pk % 2000 AS actor_px, sk * 7 AS complete_px,
         CASE WHEN pk % 103 = 0 THEN 'nan'::DOUBLE ELSE (pk % 101) / 100.0::DOUBLE END AS iou,
         (sk % 50) / 4.0::DOUBLE AS center, (60 + pk % 83) / 100.0::DOUBLE AS width,
         (60 + pk % 89) / 100.0::DOUBLE AS height, (pk % 53) / 4.0::DOUBLE AS bottom,
         CASE WHEN pk % 11 <> 0 THEN CAST(sk % 10 * 20 - 60 AS DOUBLE) END AS yaw,
         pk % 7 <> 0 AS ground_ok, pk % 13 <> 0 AS safe_ok, pk % 3 <> 0 AND pk % 17 = 0 AS broken,
         pk % 19 = 0 AS occluded, pk % 43 = 0 AS degenerate, pk % 2 = 0 AS strict_q, sk % 2 = 0 AS strict_g
  FROM obs""")

_define("gated", ("layers",), """
  SELECT *, greatest(actor_px, complete_px) AS px,
         ground_ok AND safe_ok AND NOT broken AND (yaw IS NULL OR abs(yaw) < 90) AS hard_ok,
         strict_q AND strict_g AS strict_ok,
         CASE WHEN greatest(actor_px, complete_px) < 100 THEN 0.30 WHEN greatest(actor_px, complete_px) < 400 THEN 0.33
              WHEN greatest(actor_px, complete_px) < 1600 THEN 0.36 ELSE 0.40 END::DOUBLE AS lim_iou,
         CASE WHEN greatest(actor_px, complete_px) < 100 THEN 12 WHEN greatest(actor_px, complete_px) < 400 THEN 11
              ELSE 10 END::DOUBLE AS lim_center,
         CASE WHEN greatest(actor_px, complete_px) < 100 THEN 0.70 WHEN greatest(actor_px, complete_px) < 400 THEN 0.72
              WHEN greatest(actor_px, complete_px) < 1600 THEN 0.75 ELSE 0.78 END::DOUBLE AS lim_low,
         CASE WHEN greatest(actor_px, complete_px) < 100 THEN 1.40 WHEN greatest(actor_px, complete_px) < 400 THEN 1.37
              WHEN greatest(actor_px, complete_px) < 1600 THEN 1.33 ELSE 1.30 END::DOUBLE AS lim_high,
         10::DOUBLE AS lim_bottom,
         CASE WHEN greatest(actor_px, complete_px) < 400 THEN 25 WHEN greatest(actor_px, complete_px) < 1600 THEN 24
              ELSE 22 END::DOUBLE AS lim_yaw
  FROM layers""")

_define("gate", ("gated",), """
  SELECT *, hard_ok AND (strict_ok OR adaptive_ok) AS geometry_ok FROM (
    SELECT *, NOT isnan(iou) AND iou >= lim_iou AND center <= lim_center AND width BETWEEN lim_low AND lim_high
           AND height BETWEEN lim_low AND lim_high AND (occluded OR bottom <= lim_bottom)
           AND (yaw IS NULL OR yaw <= lim_yaw) AS adaptive_ok FROM gated)""")

_define("decisions", ("obs",), """
  SELECT printf('a%011d', obj_no) AS sample_id, sha256('rq|' || obj_no) AS request_sha256, obj_no, least,
         CASE WHEN obj_no % 11 = 0 THEN 'reject' ELSE 'accept' END AS decision,
         CASE WHEN obj_no % 31 = 0 THEN 'timeout' END AS request_error,
         obj_no % 11 = 0 OR obj_no % 9 = 0 OR (obj_no % 2 = 0 AND obj_no % 23 = 0) OR obj_no % 37 = 0
           OR obj_no % 41 = 0 AS hard
  FROM (SELECT obj_no, min(q) AS least FROM obs GROUP BY 1)""")

_define("files", ("records",), """
  SELECT role, sample_id || '.png' AS name,
         CASE WHEN t = 0 AND q <= 10 THEN sha256(h || 'x') ELSE h END AS sha256
  FROM (SELECT sample_id, q, t, d, unnest(['gt','input','target']) AS role, unnest([gt, input, target]) AS h FROM records)
  WHERE d > 0 OR q > 10
  UNION ALL
  SELECT DISTINCT 'gt', scene_name || '__stray.png', sha256(scene_name) FROM records""")

_define("batches", ("records",), """
  SELECT 0 AS batch, sample_id, gt, input, target, d, q FROM records WHERE camera_id <= '3'
  UNION ALL SELECT 1, sample_id, gt, input, target, d, q FROM records WHERE camera_id >= '2'
  UNION ALL SELECT 2, sample_id || '__copy', gt, input, target, d, q FROM records WHERE q = 50""")

_define("tiles", (), """
  SELECT *, alpha * (ord + 1) / 4 AS rgb FROM (
    SELECT printf('tile-%06d', vec_id // 3) AS sample_id, CAST(vec_id % 3 AS INT) AS ord,
           CAST(vec_id * 7 % 5 AS DOUBLE) AS depth, CAST(i // 8 AS INT) AS y, CAST(i % 8 AS INT) AS x,
           least(1.0::DOUBLE, greatest(0.0::DOUBLE, CAST(embedding[i + 1] AS DOUBLE) * 2)) AS alpha,
           CAST(embedding[i + 1] AS DOUBLE) AS e
    FROM (SELECT vec_id, min(embedding) AS embedding FROM embeddings GROUP BY 1), range(64) r(i))""")


def define(name: str, needs: tuple[str, ...], body: str) -> None:
    """Add a shared expression next to the table twins."""
    _define(name, needs, body)


def with_tables(needs: tuple[str, ...], query: str, recursive: bool = False) -> str:
    """Prefix a query with the expressions it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in _CTE[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    ctes = [f"{n} AS ({_CTE[n][1]})" for n in ordered]
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + "\n" + query if ctes else query
