"""Column builders. Everything is a native expression; there are no UDFs."""

from .arrays import param_value, pivot_params
from .json import first, parse_array, parse_object, parse_objects, sum_items, sum_or_null
from .money import from_cents, from_micros, money, money_from_double, whole
from .text import (
    blank_to_null,
    campaign_status,
    device_type,
    full_name,
    has_tag,
    id_part,
    list_part,
    strip_prefix,
    surrogate_key,
    tidy,
    urn_id,
)
from .times import (
    day_from_text,
    day_to_text,
    from_epoch_micros,
    from_epoch_millis,
    instant,
    midnights_between,
)
from .urls import (
    before_query,
    percent_decode,
    referrer_domain,
    url_param,
    url_params,
    without_query_and_fragment,
)
