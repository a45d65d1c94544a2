"""Measurement types, assay formats and units that steer the assay stages."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class MeasurementType:
    name: str
    category: str
    units: str | None = None

    @property
    def potency(self) -> bool:
        return self.category == "potency"


# The names that data sets use.
POTENCY = ("IC50", "EC50", "AC50", "Ki", "Kd", "XC50")
KINETIC = {"kon": "M-1.s-1", "Kon": "M-1.s-1", "k_off": "s-1", "koff": "s-1", "Koff": "s-1"}
ADMET = {"Log BB": None, "Log D": None, "Log P": None, "Clearance": "mL.min-1.kg-1", "T1/2": "h", "Solubility": "uM", "Permeability": "cm.s-1", "Caco-2": "cm.s-1", "MDCK": "cm.s-1"}
ACTIVITY = {"Inhibition": "%", "Percent Effect": "%", "Activity": None, "Potency": None}
BAO_FORMATS = {"BAO_0000357": "protein", "BAO_0000219": "cell", "BAO_0000218": "organism", "BAO_0000221": "tissue", "BAO_0000019": "assay"}
#: Nanomoles in one unit.
UNIT_NM = {"nM": 1.0, "uM": 1e3, "mM": 1e6, "M": 1e9, "pM": 1e-3}

TYPES = {t: MeasurementType(t, "potency", "nM") for t in POTENCY}
TYPES |= {t: MeasurementType(t, "kinetic", u) for t, u in KINETIC.items()}
TYPES |= {t: MeasurementType(t, "admet", u) for t, u in ADMET.items()}
TYPES |= {t: MeasurementType(t, "activity", u) for t, u in ACTIVITY.items()}


def measurement(name: str) -> MeasurementType:
    if name not in TYPES:
        raise ValueError(f"unknown measurement type {name!r}; known: {', '.join(TYPES)}")
    return TYPES[name]


def label_column(name: str) -> str:
    """IC50 gives pIC50 and so on; types without a logarithm keep their name."""
    t = measurement(name)
    return f"p{name}" if t.potency else name


def conversion(units: str | None, legacy: bool = False) -> float:
    """C in -log10(value / C), so that values in any molar unit give the exponent of the molar value.

    legacy multiplies instead of dividing, which is right for nM only.
    """
    factor = UNIT_NM.get(units or "nM", 1.0)
    return 1e9 * factor if legacy else 1e9 / factor
