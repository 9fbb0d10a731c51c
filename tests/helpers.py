"""What the tests share besides fixtures."""

import json


def record(name="Dakar", region="Dakar", country="Senegal", time="2024-03-09 13:05", text="Sunny",
           code=1000, **changes):
    """One JSON record; changes replace fields of `current`, None removes them."""
    current = {
        "last_updated": time, "temp_c": 28.3, "condition": {"text": text, "code": code},
        "wind_kph": 12.6, "wind_degree": 340, "wind_dir": "NNW", "pressure_mb": 1013.0,
        "precip_mm": 0.0, "humidity": 61, "cloud": 10, "vis_km": 10.0, "uv": 7.0, "gust_kph": 17.9,
    }
    current |= changes
    current = {k: v for k, v in current.items() if v is not None}
    place = {"name": name, "region": region, "country": country}
    return json.dumps({"location": place, "current": current})


def rows(df, *columns):
    """The rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
