"""airshed: hourly air-quality readings to a daily air-quality index, as Spark DataFrame operators.

Layers: landing JSON envelopes -> bronze rows -> silver hourly rows (merge-upserted) ->
quality gate -> gold daily index per site -> ranked serving query. Every operator is a
function from DataFrame(s) to a DataFrame built with Catalyst expressions only.
"""

__version__ = "0.1.0"
