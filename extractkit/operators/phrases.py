"""The phrase bank: for every field, sentences that state the damage and sentences that deny it.

No sentence contains another, so a sentence found in a narrative names its field and flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from extractkit.schema import NARRATIVE_FIELDS

PhraseBank = dict[str, dict[bool, list[str]]]

PHRASES: PhraseBank = {
    "floor_water_damage": {
        True: [
            "Two inches of rainwater are sitting on the cellar floor.",
            "The lower level took on water from wall to wall.",
            "A burst pipe left the whole ground floor under water.",
            "Puddles remain on the laundry room tiles.",
            "The sump failed and the floor is submerged.",
            "River water ran in under the back door and spread over the floor.",
            "The den floor is still wet three days later.",
            "Water is pooling around the furnace.",
            "Every room downstairs has standing water.",
            "The floorboards are buckling from the leak.",
        ],
        False: [
            "The floors never got wet.",
            "Not a drop reached the cellar floor.",
            "The lower level is bone dry.",
            "All flooring stayed dry throughout.",
            "The tiles downstairs show no trace of water.",
            "The ground is dry in every room.",
        ],
    },
    "carpet_damage": {
        True: [
            "The hallway carpet squelches underfoot.",
            "The rug in the den is waterlogged.",
            "Carpeting by the stairs is drenched.",
            "The carpet padding is saturated and has to go.",
            "Brown stains have spread over the bedroom carpet.",
            "The playroom carpet has come loose and is sodden.",
            "The carpet is dripping when lifted.",
            "The wall-to-wall carpet has shrunk from the soaking.",
            "Half of the living room carpet is wet through.",
            "The runner on the landing is spoiled.",
        ],
        False: [
            "The carpets were spared.",
            "Every rug is clean and dry.",
            "The carpeting is in good order.",
            "The carpet felt dry to the touch everywhere.",
            "There is nothing wrong with the carpet.",
            "We lifted the carpet and it was dry beneath.",
        ],
    },
    "broken_plaster": {
        True: [
            "Chunks of plaster have come off the stairwell.",
            "The plasterboard is bowing and soft to the touch.",
            "Plaster is flaking behind the radiator.",
            "The wallboard has turned to mush along the skirting.",
            "A slab of plaster fell during the night.",
            "The plaster in the hallway is blistered and hollow.",
            "The gypsum panels are coming apart at the seams.",
            "I can push a finger into the drywall.",
            "The plaster finish is peeling away in sheets.",
            "The drywall has to be cut out up to knee height.",
        ],
        False: [
            "All plaster is sound.",
            "The drywall is firm everywhere.",
            "The wall finish is unharmed.",
            "We tapped the plaster and heard nothing hollow.",
            "The plasterboard held up well.",
            "The walls need no replastering.",
        ],
    },
    "mould": {
        True: [
            "Black mould has taken hold behind the sofa.",
            "Green spots of mould dot the skirting.",
            "Mould is creeping up from the corner.",
            "A fuzzy growth covers the window frame.",
            "The inspector pointed out active mould.",
            "Mould spores have settled on the shelves.",
            "White mould came up within a week.",
            "The closet is full of mould.",
            "Mould has returned twice since we wiped it off.",
            "Dark mould rings surround the vent.",
        ],
        False: [
            "There is no sign of mould.",
            "The inspector ruled out mould.",
            "We looked for mould and came up empty.",
            "Nothing is growing on the walls.",
            "All surfaces are free of mould.",
            "The mould test came back negative.",
        ],
    },
    "odor_present": {
        True: [
            "The place reeks of damp.",
            "An earthy stench fills the hallway.",
            "It smells stale downstairs.",
            "A sour odor hits you at the door.",
            "The smell of wet cardboard will not go away.",
            "Guests remarked on a foul smell.",
            "The air is heavy with a rotten odor.",
            "A sewage smell lingers by the drain.",
            "The closets have a moldy scent.",
            "There is a swampy whiff in the mornings.",
        ],
        False: [
            "The air smells fresh.",
            "Nobody noticed a smell.",
            "The rooms have no scent at all.",
            "There is no odor to speak of.",
            "It smells the same as always.",
            "A neighbor confirmed that nothing smells off.",
        ],
    },
    "electrical_damage": {
        True: [
            "The breaker trips as soon as it is reset.",
            "Two sockets are dead.",
            "The lights flicker whenever the heater starts.",
            "The fuse box got wet and hums.",
            "A light switch gave off smoke.",
            "The wiring behind the panel has shorted out.",
            "An extension socket burned out.",
            "Power is gone on the entire lower circuit.",
        ],
        False: [
            "The power works in every room.",
            "An electrician found the wiring safe.",
            "All sockets and switches passed the test.",
            "The fuse box is dry.",
            "The lights come on as they should.",
            "There was no trouble with the electrics.",
        ],
    },
    "ceiling_damage": {
        True: [
            "A brown ring has formed overhead.",
            "The ceiling sags above the bathtub.",
            "Water drips from the ceiling light.",
            "Part of the ceiling caved in.",
            "The ceiling paint is bubbling.",
        ],
        False: [
            "The ceiling is spotless.",
            "Overhead everything is dry.",
            "The ceilings show no marks.",
            "Nothing came through from above.",
            "The ceiling panels are straight and clean.",
            "We see no change in the ceiling.",
        ],
    },
    "cabinet_damage": {
        True: [
            "The vanity doors no longer close.",
            "Kitchen cupboards have swelled along the plinth.",
            "The veneer on the sideboard is lifting.",
            "The pantry shelves have bowed.",
            "The base units are delaminating.",
            "A cupboard back panel has rotted.",
            "The linen cabinet is twisted out of shape.",
            "The cabinet feet have split.",
        ],
        False: [
            "The cupboards are as good as new.",
            "Cabinet doors open and close freely.",
            "The kitchen units stayed above the water line.",
            "All cabinetry is undamaged.",
            "The vanity is fine.",
            "The shelving took no harm.",
        ],
    },
    "appliance_damage": {
        True: [
            "The dryer is dead.",
            "The freezer quit and the food is lost.",
            "The boiler will not ignite.",
            "The dishwasher leaks from its motor.",
            "The water heater shows a fault code.",
            "The stove control board fried.",
            "The washing machine drum is stuck.",
        ],
        False: [
            "The dryer and the freezer run as before.",
            "Every appliance starts up.",
            "The boiler fires without a problem.",
            "All machines were tested and work.",
            "The dishwasher finished a full cycle.",
            "The white goods were on the upper floor.",
        ],
    },
    "structural_crack": {
        True: [
            "A fresh crack runs across the bearing wall.",
            "The foundation has split near the corner.",
            "A gap has opened between the wall and the slab.",
            "The lintel over the garage is cracked.",
        ],
        False: [
            "The foundation is solid.",
            "The bearing walls have no cracks.",
            "The only crack is a cosmetic one from years ago.",
            "The engineer saw no movement in the structure.",
            "The slab is in one piece.",
        ],
    },
}

INTROS = [
    "Good morning, I need to open a claim. ",
    "This is a follow-up on our storm claim. ",
    "I am writing on behalf of my parents. ",
    "Please note the following about our house. ",
    "We returned from holiday to this. ",
    "",
]


def phrase_table(spark: SparkSession, bank: PhraseBank | None = None) -> DataFrame:
    """The bank as rows: field, flag, ord (place in a narrative), idx, n (alternatives), phrase."""
    bank = bank or PHRASES
    rows = [
        (field, flag, order, idx, len(bank[field][flag]), phrase)
        for order, field in enumerate(NARRATIVE_FIELDS)
        for flag in (True, False)
        for idx, phrase in enumerate(bank[field][flag])
    ]
    return spark.createDataFrame(
        rows, "field string, flag boolean, ord bigint, idx bigint, n bigint, phrase string"
    )
