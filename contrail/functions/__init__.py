from contrail.functions.geo import (  # noqa: F401
    box_cell, box_cells_touched, box_margin_deg, haversine_km, in_box,
    radius_key, radius_keys_reached,
)
from contrail.functions.labels import (  # noqa: F401
    blank_to_null, confidence_band, country_label, event_type_of,
    position_source_label, rel_type_of, round_avg, time_string,
)
